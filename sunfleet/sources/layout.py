"""Telemetry laid out for the daily jobs: a table partitioned by day, bucketed and sorted by device.

A job then reads the partitions of its days only, a look-up of one device reads one bucket, and everything that is grouped by device (distinct
readings, daily aggregates) runs where the readings lie, without a shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators import daily as d
from ..operators import lookback as lb
from ..schema import CORE_COLUMNS
from ..session import measured, new_path

BUCKETS = 64


def write_device_table(df: DataFrame, table: str, buckets: int = BUCKETS, path: str | None = None, mode: str = "errorifexists") -> str:
    """Write readings in standard form as a table; one file per day and bucket, so also a device with very many readings spreads over its days."""
    rows = lb.with_time(cl.standard_rows(df)).withColumn("ds", lb.day_of())
    spread = rows.repartition(F.col("ds"), F.pmod(F.hash("sn"), F.lit(buckets)))
    writer = spread.write.mode(mode).partitionBy("ds").bucketBy(buckets, "sn").sortBy("sn", "createtime")
    writer.option("path", path or new_path(df.sparkSession, "device-table")).format("parquet").saveAsTable(table)
    return table


def append_days(df: DataFrame, table: str) -> None:
    """Add readings to a laid-out table; the table knows its buckets."""
    spark = df.sparkSession
    rows = lb.with_time(cl.standard_rows(df)).withColumn("ds", lb.day_of())
    rows.select(*spark.table(table).columns).repartition("ds").write.insertInto(table)


def device_rows(spark: SparkSession, table: str, sn: str, day: dt.date | None = None) -> DataFrame:
    """Readings of one device, from its bucket, of one day if given."""
    rows = spark.table(table).filter(F.col("sn") == F.lit(sn))
    return rows if day is None else rows.filter(F.col("ds") == F.lit(day))


def profile(spark: SparkSession, table: str) -> DataFrame:
    """(sn, last_seen, reasons) over the whole history, without a shuffle; the incremental state keeps the same table up to date."""
    return cl.device_profile(cl.repair_sensors(spark.table(table)), F.max("ds").alias("last_seen"))


def windowed_rows(
    spark: SparkSession, table: str, devices: DataFrame, out_days: int = 0, time_range: int = 7, visible_date: dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """(clean readings inside the day windows of ``devices`` (sn, last_seen), windows); only partitions of these days are read."""
    windows = measured(lb.day_windows(devices, out_days, time_range, visible_date), "windows")
    # two dates
    span = windows.agg(F.min("start_date").alias("first"), F.max("last_date").alias("last")).first()
    rows = spark.table(table)
    inside = rows.filter(F.col("ds").between(F.lit(span["first"]), F.lit(span["last"]))) if span["first"] else rows.filter(F.lit(False))
    near = lb.rows_in_day_window(inside, windows).select(*CORE_COLUMNS)
    return cl.repair_sensors(cl.dedupe_rows(near)), windows


def daily_aggregates(
    spark: SparkSession, table: str, devices: DataFrame, out_days: int = 0, time_range: int = 7, visible_date: dt.date | None = None,
    spec: d.DailySpec = d.EVERYTHING,
) -> tuple[DataFrame, DataFrame]:
    """(daily rows, windows): no reading changes its place before they are aggregated."""
    rows, windows = windowed_rows(spark, table, devices, out_days, time_range, visible_date)
    return d.daily_aggregates(rows, spec), windows
