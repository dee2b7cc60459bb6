"""Seeded samples and splits. Every random order is an md5 key of the row identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..session import measured
from .ranking import ranked


def shuffle_rows(df: DataFrame, identity: Sequence[str], seed: int) -> DataFrame:
    return df.orderBy(fn.seeded_key(identity, seed))


def model_proportions(devices: DataFrame, total: int) -> DataFrame:
    """Per model: count, share, exact quota for ``total`` devices, its floor and its fraction."""
    # one row per device model: the window below sees the model list, not the devices
    counts = (
        devices.withColumn("sn_prefix", fn.model_prefix())
        .groupBy("sn_prefix")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    share = F.col("count").cast("double") / F.sum("count").over(Window.partitionBy()).cast("double")
    exact = F.col("proportion") * F.lit(float(total))
    return (
        counts.withColumn("proportion", share)
        .withColumn("exact_required", exact)
        .withColumn("required_count", F.floor("exact_required").cast("bigint"))
        .withColumn("fraction", F.col("exact_required") - F.floor("exact_required"))
    )


def model_quotas(devices: DataFrame, total: int) -> DataFrame:
    """Quotas by largest remainder (ties by model), capped at the devices available."""
    everything = Window.partitionBy()
    by_fraction = Window.partitionBy().orderBy(F.desc("fraction"), "sn_prefix")
    short = F.sum("count").over(everything) < total
    quotas = (
        model_proportions(devices, total)
        .withColumn("leftover", F.lit(total) - F.sum("required_count").over(everything))
        .withColumn("place", F.row_number().over(by_fraction))
        .withColumn(
            "required_count",
            F.when(short, F.raise_error(F.lit(f"fewer than {total} devices to sample from")).cast("bigint"))
            .otherwise(F.col("required_count") + F.when(F.col("place") <= F.col("leftover"), 1).otherwise(0)),
        )
    )
    return quotas.select(
        "sn_prefix", "count", fn.cap_at("required_count", "count").cast("bigint").alias("required_count")
    )


def quota_join(devices: DataFrame, quotas: DataFrame) -> DataFrame:
    """Every device with the quota of its model."""
    prefixed = devices.withColumn("sn_prefix", fn.model_prefix())
    return prefixed.join(quotas.select("sn_prefix", "required_count"), "sn_prefix", "left")


def top_up_sample(unselected: DataFrame, short: DataFrame, seed: int) -> DataFrame:
    """The first ``short`` devices of the unselected in seeded order; ``short`` is a one-row frame."""
    numbered = ranked(unselected, fn.seeded_key(["sn", F.lit("top-up")], seed), name="_rank")
    joined = numbered.join(F.broadcast(short))  # one row by construction
    return joined.filter(F.col("_rank") <= F.col("short")).select(*unselected.columns)


def proportional_sample(devices: DataFrame, total: int, seed: int) -> DataFrame:
    """``total`` devices with the model shares of the whole list: (sn_prefix, sn)."""
    devices = devices.select("sn")
    quotas = model_quotas(devices, total)
    # the rank runs on (sn_prefix, sn) only, the quota is attached to the ranked list
    prefixed = devices.withColumn("sn_prefix", fn.model_prefix())
    numbered = ranked(prefixed, fn.seeded_key(["sn"], seed), ["sn_prefix"], "row_num").join(
        quotas.select("sn_prefix", "required_count"), "sn_prefix"
    )
    chosen = F.col("row_num") <= F.col("required_count")
    short = quotas.agg((F.lit(total) - F.sum("required_count")).alias("short"))
    extra = top_up_sample(numbered.filter(~chosen).select("sn_prefix", "sn"), short, seed)
    return numbered.filter(chosen).select("sn_prefix", "sn").unionByName(extra)


def consecutive_days(df: DataFrame, days: int = 20, months: Sequence[str] | None = None, seed: int = 0) -> DataFrame:
    """(ym, date): per month ``days`` consecutive available days from a seeded random start.

    Months with fewer available days are skipped. Works on the calendar, never on readings.
    """
    calendar = df.select(F.to_date("createtime").alias("date")).distinct()
    calendar = calendar.withColumn("ym", F.date_format("date", "yyyyMM"))
    if months is not None:
        calendar = calendar.filter(F.col("ym").isin(*months))
    month = Window.partitionBy("ym")
    numbered = calendar.select(
        "ym",
        "date",
        F.row_number().over(month.orderBy("date")).alias("day_no"),
        F.count(F.lit(1)).over(month).alias("available"),
    )
    possible = numbered.filter(F.col("day_no") <= F.col("available") - F.lit(days - 1))
    starts = possible.groupBy("ym").agg(
        F.min_by("day_no", fn.seeded_key(["date"], seed)).alias("start_no")
    )
    inside = (F.col("day_no") >= F.col("start_no")) & (F.col("day_no") < F.col("start_no") + days)
    return numbered.join(starts, "ym").filter(inside).select("ym", "date")


def consecutive_days_sample(
    df: DataFrame, devices: DataFrame, days: int = 20, months: Sequence[str] | None = None, seed: int = 0
) -> DataFrame:
    """Readings of the listed devices on the sampled days."""
    chosen = measured(consecutive_days(df, days, months, seed).select("date"), "days")
    return (
        df.join(devices.select("sn").distinct(), "sn", "left_semi")
        .withColumn("date", F.to_date("createtime"))
        .join(chosen, "date", "left_semi")
        .drop("date")
    )


def stratified_split(
    df: DataFrame, label: str, identity: Sequence[str], test_size: float, seed: int
) -> DataFrame:
    """Adds ``split`` = test for the first ``ceil(n * test_size)`` rows of each class, else train."""
    numbered = ranked(df, fn.seeded_key(identity, seed), [label], "_rank", "_size")
    test = F.col("_rank") <= F.ceil(F.col("_size") * F.lit(float(test_size)))
    return numbered.withColumn("split", F.when(test, "test").otherwise("train")).drop("_rank", "_size")


def per_class_split(
    df: DataFrame, label: str, identity: Sequence[str], train_fraction: float = 0.85, seed: int = 0
) -> DataFrame:
    """Adds ``split`` = train for the first ``floor(n * fraction)`` rows of each class, else val."""
    numbered = ranked(df, fn.seeded_key(identity, seed), [label], "_rank", "_size")
    train = F.col("_rank") <= F.floor(F.col("_size") * F.lit(float(train_fraction)))
    return numbered.withColumn("split", F.when(train, "train").otherwise("val")).drop("_rank", "_size")


def stratified_kfold(
    df: DataFrame, label: str, identity: Sequence[str], folds: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``fold`` 0..folds-1; class sizes of two folds differ by at most one."""
    numbered = ranked(df, fn.seeded_key(identity, seed), [label], "_rank")
    return numbered.withColumn("fold", (F.col("_rank") - 1) % folds).drop("_rank")


def head_and_rest(df: DataFrame, order: Sequence[str], rows: int = 4) -> tuple[DataFrame, DataFrame]:
    """First ``rows`` rows in a unique order, and all others."""
    head = df.orderBy(*order).limit(rows)
    return head, df.join(head.select(*order), list(order), "left_anti")
