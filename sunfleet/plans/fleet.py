"""Preparation of fault sets, healthy sets and the monthly fleet extract."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import cleaning as cl
from ..operators import lookback as lb
from ..operators import sampling
from ..sources import readers, writers
from ..session import measured
from .cleaning import clean_telemetry


def fault_set(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two fault extracts as one clean set; the month key is the plain device id."""
    clean, _ = clean_telemetry(first.unionByName(second).dropDuplicates(), cast=False)
    return clean.withColumn("sn_ym", F.col("sn"))


def ok_set(
    df: DataFrame, devices: DataFrame, total: int, days: int = 20,
    months: Sequence[str] | None = None, seed: int = 42,
) -> DataFrame:
    """Proportional device sample, its readings on consecutive days per month, clean, with month key.

    Readings of a month are cleaned on their own: a device silent in one month is dropped there.
    """
    chosen = measured(sampling.proportional_sample(devices, total, seed))
    rows = sampling.consecutive_days_sample(df, chosen, days, months, seed)
    return clean_per_month(rows)


def clean_per_month(df: DataFrame) -> DataFrame:
    rows = cl.standard_rows(df, cast=False)
    keyed = rows.withColumn("sn_ym", fn.month_key("sn", "createtime"))
    repaired = cl.repair_sensors(keyed)
    silent = repaired.groupBy("sn_ym").agg(*cl.silent_flags())
    hit = F.lit(False)
    for rule in cl.SILENT_RULES:
        hit = hit | F.col(f"silent_{rule}")
    dropped = measured(silent.filter(hit).select("sn_ym"))
    return cl.repair_sensors(cl.dedupe_rows(keyed)).join(dropped, "sn_ym", "left_anti")


def fleet_prepare(df: DataFrame, run_date: dt.date, clean: bool = True) -> DataFrame:
    """Last month's readings of all devices; ``clean=False`` is the variant for inactive data."""
    start, end = readers.trailing_month_range(run_date)
    month = readers.in_date_range(df.withColumn("ds", lb.day_of()), start, end).drop("ds")
    return clean_telemetry(month, cast=False)[0] if clean else month


def write_fleet(
    spark: SparkSession, folder: str, out: str, run_date: dt.date, size: int = 1000, clean: bool = True
) -> str:
    """Dated files of the last month to sorted device batches."""
    start, end = readers.trailing_month_range(run_date)
    rows = readers.files_by_date_range(spark, folder, start, end)
    if clean:
        rows, _ = clean_telemetry(rows, cast=False)
    return writers.write_batches(rows, out, size)


def last_full_day_rows(df: DataFrame, min_times: int = 100) -> DataFrame:
    """Clean readings of each device's last day with enough distinct reading times."""
    clean, _ = clean_telemetry(df)
    return lb.last_full_day_join(lb.with_time(clean), min_times)
