"""Daily features from a stored state that arriving files bring up to date.

The state of a folder has three tables:

* ``readings/batch=<name>/ds=<day>``: the readings of every batch in standard form. A batch that is delivered again replaces itself.
* ``daily/ds=<day>``: one row per device and day. Where readings lie at midnight there are two, ``day_part`` 0 and 1 of ``plans.training.offset_days``;
  elsewhere both are the same and the one row has a NULL there.
* ``profile/batch=<name>``: what a batch says about its devices; flags and newest days of all batches merge by AND and maximum.

A batch aggregates only the (device, day) pairs it touches anew, from all their readings, so late files and copies end in the same state as one full run.
A day of which it touches at least half of the devices is aggregated as a whole: neither readings nor daily rows are then joined with the touched pairs.
Only partitions of touched days are read and written. A run that failed is repeated under the same name.

The readings of a device-day meet in one task, which drops the copies and aggregates: they are shuffled once. A device-day of more than ``LONG_DAY`` stored
readings goes by whole rows and hours instead, so its copies are combined before they are shuffled and its aggregate spreads.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cleaning as cl
from ..operators import daily as d
from ..operators import lookback as lb
from ..schema import CORE_COLUMNS
from ..session import measured, written
from .daily import complete_days, matrix_columns, matrix_from_days

READINGS, DAILY, PROFILE = "readings", "daily", "profile"
LONG_DAY = 100_000
#: Groups of devices whose readings of a day are counted before those of every device are.
CELLS = 256


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def stored_readings(spark: SparkSession, root: str, days: list[dt.date]) -> DataFrame:
    """Readings of the given days, from the partitions of these days alone."""
    schema = spark.read.parquet(os.path.join(root, READINGS)).select(*CORE_COLUMNS).schema
    typed = T.StructType([*schema, T.StructField("batch", T.StringType()), T.StructField("ds", T.DateType())])
    return spark.read.schema(typed).parquet(os.path.join(root, READINGS)).filter(F.col("ds").isin(days))


def stored_days(spark: SparkSession, root: str, first: dt.date, last: dt.date) -> DataFrame:
    """Daily rows of ``[first, last]``."""
    return spark.read.parquet(os.path.join(root, DAILY)).filter(F.col("ds").between(F.lit(first), F.lit(last)))


def long_days(readings: DataFrame, most: int) -> DataFrame | None:
    """(sn, ds) with more than ``most`` stored readings; None if there are none."""
    cells = readings.groupBy("ds", F.pmod(F.hash("sn"), F.lit(CELLS))).count()
    if cells.filter(F.col("count") > most).isEmpty():
        return None
    found = measured(readings.groupBy("sn", "ds").count().filter(F.col("count") > most).select("sn", "ds"), "long-days")
    return None if found.isEmpty() else found


def day_rows(readings: DataFrame, spec: d.DailySpec = d.EVERYTHING, long_day: int = LONG_DAY, among: DataFrame | None = None) -> DataFrame:
    """Daily rows (sn, day_part, ds, values) of stored readings with all their copies. ``among`` holds at least their (sn, createtime, ds)."""
    pair, at_midnight = ["sn", "ds"], F.col("createtime") == F.date_trunc("day", F.col("createtime"))
    among = readings if among is None else among
    midnights = measured(among.filter(at_midnight).select(*pair).distinct(), "midnights").withColumn("_split", F.lit(True))
    parts = F.when(F.col("_split").isNull(), F.array(F.lit(None).cast("int"))).when(at_midnight, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))

    def aggregated(rows: DataFrame) -> DataFrame:
        split = cl.repair_sensors(rows).join(midnights, pair, "left").withColumn("day_part", F.explode(parts))
        # the aggregate sorts by its keys in any case; sums of doubles in one order, newest first, are the same for every split into batches
        ordered = split.sortWithinPartitions("sn", "day_part", "ds", F.desc("createtime"), F.desc("etotal"))
        return d.daily_aggregates(ordered, spec, ["day_part"], F.col("ds")).withColumnRenamed("date", "ds")

    rows = readings.select(*CORE_COLUMNS, "ds")
    far = long_days(among, long_day)
    if far is None:
        return aggregated(cl.dedupe_rows(rows.repartition(*pair)))
    short = aggregated(cl.dedupe_rows(rows.join(far, pair, "left_anti").repartition(*pair)))
    return short.unionByName(aggregated(d.pack_by_hour(cl.dedupe_rows(rows.join(far, pair, "left_semi")))))


def absorb(spark: SparkSession, root: str, batch: DataFrame, name: str, spec: d.DailySpec = d.EVERYTHING) -> list[dt.date]:
    """Add a batch of raw readings to the state; returns the days it touched."""
    rows = lb.with_time(cl.standard_rows(batch)).withColumn("ds", lb.day_of())
    own = os.path.join(root, READINGS, f"batch={name}")
    rows.hint("rebalance", F.col("ds")).write.mode("overwrite").partitionBy("ds").parquet(own)
    if not _exists(spark, own):  # no reading of the maker's devices
        return []
    new = spark.read.schema(rows.schema).parquet(own)
    seen = cl.repair_sensors(new).groupBy("sn").agg(*cl.silent_flags(), F.max("ds").alias("last_seen"))
    seen.write.mode("overwrite").parquet(os.path.join(root, PROFILE, f"batch={name}"))

    touched = measured(new.filter("ds is not null").select("sn", "ds").distinct(), "touched-days")
    # as many dates as the batch has days
    counts = {r["ds"]: r["count"] for r in touched.groupBy("ds").count().collect()}
    days = sorted(counts)
    if not days:
        return []
    folder, known = os.path.join(root, DAILY), {}
    if _exists(spark, folder):
        daily = spark.read.parquet(folder)
        stored = daily.filter(F.col("ds").isin(days) & (F.coalesce("day_part", F.lit(0)) == 0)).groupBy("ds").count()
        known = {r["ds"]: r["count"] for r in stored.collect()}
    partly = [day for day in days if 2 * counts[day] < known.get(day, 0)]
    readings = among = stored_readings(spark, root, days)
    if partly:
        within = F.col("ds").isin(partly)
        readings = readings.filter(~within).unionByName(readings.filter(within).join(touched, ["sn", "ds"], "left_semi"))
    fresh = day_rows(readings, spec, among=among)
    if partly:
        kept = daily.filter(within).join(touched, ["sn", "ds"], "left_anti")
        # a folder is not overwritten while it is read
        fresh = written(kept, "untouched-daily").unionByName(fresh)
    fresh.hint("rebalance", F.col("ds")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ds").parquet(folder)
    return days


def device_profile(spark: SparkSession, root: str) -> DataFrame:
    """(sn, last_seen, reasons) over all batches."""
    flags = [f"bool_and(silent_{rule}) as silent_{rule}" for rule in cl.SILENT_RULES]
    merged = spark.read.parquet(os.path.join(root, PROFILE)).groupBy("sn").agg(*[F.expr(f) for f in flags], F.max("last_seen").alias("last_seen"))
    reasons = ", ".join(f"if(silent_{rule}, '{rule}', null)" for rule in cl.SILENT_RULES)
    return merged.selectExpr("sn", "last_seen", f"array_compact(array({reasons})) as reasons")


def features(
    spark: SparkSession, root: str, out_days: int = 0, time_range: int = 7, visible_date: dt.date | None = None, spec: d.DailySpec = d.EVERYTHING
) -> DataFrame:
    """The feature matrix of ``plans.daily.daily_features``, from the daily rows of the windows."""
    profile = measured(device_profile(spark, root))
    windows = lb.day_windows(profile.filter(F.size("reasons") == 0).select("sn", "last_seen"), out_days, time_range, visible_date)
    span = windows.agg(F.min("start_date").alias("first"), F.max("last_date").alias("last")).first()
    if span["first"] is None:
        span = {"first": dt.date(1, 1, 1), "last": dt.date(1, 1, 1)}
    daily = stored_days(spark, root, span["first"], span["last"]).withColumnsRenamed({"sn": "_sn", "ds": "_ds", "day_part": "_part"})
    spine = lb.date_spine(windows).withColumn("day_part", F.when(F.col("day_idx") == 0, 1).otherwise(0))
    joined = spine.join(daily, F.expr("sn = _sn and date = _ds and coalesce(_part, day_part) = day_part"), "left")
    days = complete_days(joined.drop("_sn", "_ds", "_part", "day_part"), spec)
    return matrix_from_days(days, matrix_columns(time_range, spec.thresholds))
