"""Inputs of the registered queries, all derived from the given ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunfleet.plans.cleaning import clean_telemetry
from sunfleet.sources.event_log import device_id, read_telemetry, telemetry_from_events


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    return read_telemetry(spark, sf)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_telemetry(telemetry(spark, sf))[0]


def users(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, sn) of every device."""
    listed = events(spark, sf).select("user_id").distinct()
    return listed.selectExpr("user_id", f"{device_id('user_id')} as sn")


def fault_labels(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id") % 4
    kind = F.when(u == 1, 1).when(u == 3, 2)
    return users(spark, sf).select("sn", kind.alias("error_type")).filter("error_type is not null")


def all_labels(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id") % 4
    return users(spark, sf).select("sn", F.when(u == 1, 1).when(u == 3, 2).otherwise(0).alias("label"))


def ok_devices(spark: SparkSession, sf: str) -> DataFrame:
    return users(spark, sf).filter(F.col("user_id") % 2 == 0).select("sn")


def fetch_list(spark: SparkSession, sf: str) -> DataFrame:
    """(sn, return_date), every second device listed twice."""
    u = F.col("user_id")
    day = F.date_add(F.to_date(F.lit("2024-01-15")), (u % 15).cast("int"))
    once = users(spark, sf).select("user_id", "sn", day.alias("day"))
    again = once.filter(u % 2 == 0).withColumn("day", F.date_add("day", 3))
    both = once.unionByName(again)
    return both.select("sn", F.date_format("day", "yyyyMMdd").alias("return_date"))


def latest_readings(spark: SparkSession, sf: str) -> DataFrame:
    """(sn, k) of the newest event per device."""
    t = telemetry_from_events(events(spark, sf))
    return t.groupBy("sn").agg(F.max_by("k", F.struct("createtime", "etotal")).alias("k"))


def score_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(sn, proba_label_0..2) from the newest reading of each device."""
    k = F.col("k")
    p1 = (k % 50).cast("double") / 50
    p2 = (1.0 - p1) * ((k * 7) % 50).cast("double") / 50
    rows = latest_readings(spark, sf).select(
        "sn", p1.alias("proba_label_1"), p2.alias("proba_label_2")
    )
    return rows.withColumn(
        "proba_label_0", 1.0 - F.col("proba_label_1") - F.col("proba_label_2")
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """(sn, label, prediction) for every device."""
    rows = all_labels(spark, sf).join(latest_readings(spark, sf), "sn")
    shifted = F.col("label") + F.when(F.col("k") % 5 == 0, 1).otherwise(0)
    return rows.select("sn", "label", (shifted % 3).alias("prediction"))


def non_finite(spark: SparkSession, sf: str) -> DataFrame:
    """Readings whose metrics hold +inf, -inf, NaN and NULL at known places."""
    t = telemetry_from_events(events(spark, sf))
    k = F.col("k")
    inf = float("inf")
    return t.select(
        "sn",
        "etotal",
        F.when(k % 17 == 0, inf).otherwise(F.col("vac1")).alias("a"),
        F.when(k % 19 == 0, -inf).when(k % 23 == 0, inf).otherwise(F.col("iac1")).alias("b"),
        F.when(k % 29 == 0, float("nan")).otherwise(F.col("temperature")).alias("c"),
    )
