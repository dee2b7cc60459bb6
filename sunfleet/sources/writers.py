"""Writers: features, CSV reports, day partitions, device batches and the column manifest."""

from __future__ import annotations

import os
import posixpath
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import device_batches


def stamped_path(folder: str, run_stamp: str, name: str) -> str:
    """``<folder>/<stamp>_<name>``; the caller names the run, so a repeated run is repeatable."""
    return os.path.join(folder, f"{run_stamp}_{name}")


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def _parts(path: str) -> tuple[str, str, str]:
    """Scheme, authority and path without ``.`` and ``..`` of a folder name; a plain path is a local file."""
    uri = urlsplit(path)
    if uri.scheme in ("", "file"):
        return "file", "", os.path.abspath(uri.path)
    return uri.scheme, uri.netloc, posixpath.normpath("/" + uri.path.lstrip("/"))


def overwrite_output(df: DataFrame, root: str, path: str) -> str:
    """Replace an output folder, written under the name as given; paths outside ``root`` are refused."""
    (*store, base), (*other, full) = _parts(root), _parts(path)
    if store != other or full == base or posixpath.commonpath([base, full]) != base:
        raise ValueError(f"{path} is not below {root}")
    df.write.mode("overwrite").parquet(path)
    return path


def write_days(df: DataFrame, path: str, day: str = "ds") -> str:
    """One folder per day; a rerun replaces only the days it writes. Large days get more files."""
    (
        df.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    return path


def batched_rows(df: DataFrame, size: int = 1000, seed: int = 0) -> DataFrame:
    """Readings with the batch of their device."""
    return df.join(device_batches(df, size, seed), "sn")


def write_batches(df: DataFrame, path: str, size: int = 1000, seed: int = 0) -> str:
    """One folder per batch of devices, files sorted by (sn, createtime).

    Ranges of (batch, device, time) spread a device with very many readings over several files.
    """
    order = ["batch_id", "sn", "createtime"]
    (
        batched_rows(df, size, seed)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("batch_id")
        .parquet(path)
    )
    return path


def write_manifest(spark: SparkSession, columns: Sequence[str], path: str) -> str:
    rows = [(i, c) for i, c in enumerate(columns)]
    spark.createDataFrame(rows, "position int, column_name string").write.mode("overwrite").parquet(path)
    return path


def write_by_label(scores: DataFrame, path: str) -> str:
    scores.write.mode("overwrite").partitionBy("label").parquet(path)
    return path
