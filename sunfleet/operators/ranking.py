"""Exact row numbers without a window over a whole group.

A class or a device model can hold a large share of all rows. The order key is a uniform hash,
so its first digits cut every group into equal, ordered buckets: count per bucket, add up the
counts of the buckets before, number the rows inside a bucket. No task sees more than one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn

BUCKET_DIGITS = 3


def ranked(
    df: DataFrame, key: Column, groups: Sequence[str] = (), name: str = "rank",
    size: str | None = None, digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Adds ``name`` (1, 2, ... per group in key order) and on request the group size.

    ``key`` is a hex hash of the row identity; group columns hold no NULL.
    """
    groups = list(groups)
    keyed = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, digits))
    counts = keyed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # at most 16 ** digits rows per group
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(*groups)
    offsets = counts.select(
        *groups,
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_size"),
    )
    local = F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy("_key"))
    out = keyed.withColumn("_local", local).join(offsets, [*groups, "_bucket"])
    out = out.withColumn(name, F.col("_before") + F.col("_local"))
    if size:
        out = out.withColumn(size, F.col("_size"))
    return out.select(*df.columns, name, *([size] if size else []))


def rank_in_model(devices: DataFrame, seed: int) -> DataFrame:
    """Running number of each device inside its model, in seeded random order."""
    prefixed = devices.withColumn("sn_prefix", fn.model_prefix())
    return ranked(prefixed, fn.seeded_key(["sn"], seed), ["sn_prefix"], "row_num")


def row_number_index(df: DataFrame, identity: Sequence[str], seed: int = 0, name: str = "index") -> DataFrame:
    """A dense index from 0 in the order of the seeded key of ``identity``."""
    out = ranked(df, fn.seeded_key(identity, seed), name=name)
    return out.withColumn(name, F.col(name) - 1)


def device_batches(df: DataFrame, size: int = 1000, seed: int = 0) -> DataFrame:
    """(sn, batch_id): distinct devices in batches of ``size``."""
    numbered = ranked(df.select("sn").distinct(), fn.seeded_key(["sn"], seed), name="_rank")
    return numbered.select("sn", F.floor((F.col("_rank") - 1) / size).alias("batch_id"))
