"""Readers for telemetry files, dated file sets and the warehouse table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILE_DATE = r"(\d{8})"


def read_file(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet or CSV by suffix; CSV gets its schema from the caller and is never inferred."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".csv":
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    raise ValueError(f"unsupported file format: {suffix!r}")


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Only the configured columns; a missing one is an error."""
    df = read_file(spark, path, schema)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found in {path}: {missing}")
    return df.select(*columns)


def read_folder(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All parquet files of a folder as one frame; a device may be spread over files."""
    df = spark.read.option("mergeSchema", True).parquet(folder)
    return df.select(*columns) if columns else df


def file_date() -> Column:
    """The first 8-digit date in the name of the file a row comes from."""
    return F.try_to_date(F.regexp_extract(F.col("_metadata.file_name"), FILE_DATE, 1), "yyyyMMdd")


def files_by_date_range(
    spark: SparkSession, folder: str, start: str, end: str, schema: StructType | None = None
) -> DataFrame:
    """Rows of the files below ``folder`` whose name holds a date in ``[start, end]``.

    The file name is a constant of the file, so other files are not opened.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    df = (reader.schema(schema) if schema is not None else reader).parquet(folder)
    first, last = (F.to_date(F.lit(d), "yyyyMMdd") for d in (start, end))
    return df.filter(file_date().between(first, last))


def in_date_range(df: DataFrame, start: str, end: str, column: str = "ds") -> DataFrame:
    """Partition filter on a date column, both ends included."""
    first, last = (F.to_date(F.lit(d), "yyyyMMdd") for d in (start, end))
    return df.filter(F.col(column).between(first, last))


def trailing_month_range(run_date: dt.date) -> tuple[str, str]:
    """(start, end) as yyyymmdd for a job that runs on ``run_date``; a missing day clamps."""
    end = run_date - dt.timedelta(days=1)
    year, month = (end.year - 1, 12) if end.month == 1 else (end.year, end.month - 1)
    month_end = (dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)).day
    start = dt.date(year, month, min(end.day, month_end))
    return start.strftime("%Y%m%d"), end.strftime("%Y%m%d")


def daily_predicates(start: str, end: str, prefix: str = "TP", date_column: str = "ds") -> list[str]:
    """One warehouse predicate per day: each becomes one read partition."""
    first, last = (dt.datetime.strptime(d, "%Y%m%d").date() for d in (start, end))
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    return [
        f"{date_column} >= DATE '{d}' AND {date_column} < DATE '{d + dt.timedelta(days=1)}' "
        f"AND sn LIKE '{prefix}%'"
        for d in days
    ]


def read_warehouse_days(
    spark: SparkSession, url: str, table: str, start: str, end: str,
    properties: dict[str, str] | None = None, prefix: str = "TP",
) -> DataFrame:
    """Readings of the days from a JDBC table; URL and credentials come from the caller."""
    return spark.read.jdbc(url, table, predicates=daily_predicates(start, end, prefix), properties=properties or {})


def daily_extract(df: DataFrame, start: str, end: str, prefix: str = "TP", day: str | None = None) -> DataFrame:
    """Readings of the maker's devices in ``[start, end]`` with their day in ``ds``."""
    stamped = df if day == "ds" else df.withColumn("ds", F.to_date(F.col(day or "createtime")))
    return in_date_range(stamped.filter(F.col("sn").startswith(prefix)), start, end)


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Column list of a model: a one-column table of a few hundred names."""
    rows = spark.read.parquet(path).orderBy("position").collect()
    return [r["column_name"] for r in rows]


def project_manifest(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Columns in manifest order; ``None`` means there is no manifest."""
    return df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns])
