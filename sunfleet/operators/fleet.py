"""Device lists, lookups, joins with side inputs and counts over the fleet.

No join carries a broadcast hint: list sizes are not bounded by the code, so the planner
decides from measured sizes (statistics, and at run time the finished stage).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn


def distinct_devices(df: DataFrame) -> DataFrame:
    return df.select("sn").distinct()


def devices_in(df: DataFrame, devices: DataFrame) -> DataFrame:
    return df.join(devices.select("sn"), "sn", "left_semi")


def devices_not_in(df: DataFrame, devices: DataFrame) -> DataFrame:
    return df.join(devices.select("sn"), "sn", "left_anti")


def device_day_lookup(df: DataFrame, sn: str, day: dt.date | str) -> DataFrame:
    """Readings of one device on one calendar day; both predicates reach the scan."""
    start = F.to_date(F.lit(day)) if isinstance(day, str) else F.lit(day)
    t = F.col("createtime")
    return df.filter(
        (F.col("sn") == sn)
        & (t >= start.cast("timestamp"))
        & (t < F.date_add(start, 1).cast("timestamp"))
    )


def distinct_pairs(df: DataFrame, date: str = "return_date") -> DataFrame:
    return df.select("sn", date).dropDuplicates()


def first_per_device(fetch_list: DataFrame, date: str = "return_date") -> DataFrame:
    """One date per device: the earliest."""
    return distinct_pairs(fetch_list, date).groupBy("sn").agg(F.min(date).alias(date))


def interval_fetch(df: DataFrame, fetch_list: DataFrame, days: int = 60, date: str = "return_date") -> DataFrame:
    """Readings of the ``days`` before each listed device's date, both ends included."""
    wanted = first_per_device(fetch_list, date)
    if dict(wanted.dtypes)[date] == "string":
        wanted = wanted.withColumn(date, F.to_date(date, "yyyyMMdd"))
    end = F.col(date).cast("timestamp")
    start = F.date_sub(F.col(date), days).cast("timestamp")
    return df.join(wanted, "sn").filter(F.col("createtime").between(start, end))


def interval_fetch_all(df: DataFrame, fetch_list: DataFrame, days: int = 60, date: str = "return_date") -> DataFrame:
    """Readings of the ``days`` before every listed date of a device, both ends included; overlapping intervals each get the reading.

    Intervals are cut at months, and readings meet them by (device, month) and only then by time: the history of one
    device spreads over its months, and a reading is compared with the intervals of its own month alone.
    """
    listed = fetch_list.select("sn", F.col(date).alias("_date"))
    if dict(listed.dtypes)["_date"] == "string":
        listed = listed.withColumn("_date", F.to_date("_date", "yyyyMMdd"))
    wanted = listed.dropDuplicates().selectExpr(
        "sn as _sn", "_date", "cast(date_sub(_date, {0}) as timestamp) as _start".format(int(days)), "cast(_date as timestamp) as _end"
    ).selectExpr("*", "explode(sequence(trunc(_start, 'MM'), trunc(_end, 'MM'), interval 1 month)) as _month")
    rows = df.withColumn("_own_month", F.trunc("createtime", "MM"))
    met = rows.join(wanted, (F.col("sn") == F.col("_sn")) & (F.col("_own_month") == F.col("_month")))
    inside = met.filter(F.col("createtime").between(F.col("_start"), F.col("_end")))
    return inside.withColumn(date, F.col("_date")).drop("_sn", "_date", "_start", "_end", "_month", "_own_month")


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("createtime"), "sn")


def sort_device_time(df: DataFrame) -> DataFrame:
    return df.orderBy("sn", "createtime")


def label_join(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach ``error_type``; devices without one are dropped."""
    wanted = labels.filter(F.col("error_type").isNotNull()).select("sn", "error_type")
    return features.join(wanted, "sn")


def attach_label(df: DataFrame, label: int) -> DataFrame:
    return df.withColumn("label", F.lit(label))


def error_type_as_label(df: DataFrame) -> DataFrame:
    return df.drop("label").withColumnRenamed("error_type", "label")


def attach_cutoff_time(scores: DataFrame, cutoffs: DataFrame) -> DataFrame:
    return scores.join(cutoffs.select("sn", "time"), "sn", "left")


def count_by_model(devices: DataFrame) -> DataFrame:
    counts = devices.groupBy(fn.model_prefix().alias("sn_prefix")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "sn_prefix")


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def latest_version(registry: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Newest path per group; ties by path."""
    newest = F.max(F.struct("modified", "path"))["path"].alias("path")
    return registry.groupBy(*groups).agg(newest)


def top_n_importance(scores: DataFrame, n: int = 20) -> DataFrame:
    """(feature, percent): the ``n`` largest scores as share of the total."""
    total = scores.agg(F.sum("score").alias("total"))
    share = F.col("score") / F.col("total") * 100
    joined = scores.join(F.broadcast(total))  # one row by construction
    return joined.select("feature", share.alias("percent")).orderBy(F.desc("percent"), "feature").limit(n)
