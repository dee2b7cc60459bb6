"""Exact quantiles per group without holding a group in one task.

Equal values collapse to (value, count) on the map side. Value bins between the group's minimum
and maximum carry running counts, so ranks inside a bin only need the values of that bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

BINS = 1024


def quantile_name(q: float) -> str:
    return f"quantile_{q}".replace(".", "_")


def _bin_number(bins: int) -> str:
    """Order-preserving bin of ``_v`` between ``_lo`` and ``_hi``.

    Equal widths cut evenly spread values, the distance from either end on a log scale cuts values
    that crowd together because of a far outlier. Each part never falls as the value rises, so
    their combination keeps the order and takes at most ``3 * bins`` values.
    """

    def part(distance, span):
        share = f"coalesce(try_divide({distance}, {span}), 0.0D)"
        return f"least(greatest(floor({share} * {bins}), 0L), {bins - 1}L)"

    even = part("_v - _lo", "_hi - _lo")
    from_low = part("log1p(_v - _lo)", "log1p(_hi - _lo)")
    from_high = f"({bins - 1}L - {part('log1p(_hi - _v)', 'log1p(_hi - _lo)')})"
    return f"(({even} * {bins}L + {from_low}) * {bins}L + {from_high})"


def group_quantiles(
    long: DataFrame, keys: Sequence[str], quantiles: dict[str, float], value: str = "value",
    interpolation: str = "linear", bins: int = BINS, small: int = BINS,
) -> DataFrame:
    """One row per key with one column per entry of ``quantiles``; NULL values are ignored.

    ``nearest`` takes the element at ``round(q * (n - 1))``, ``linear`` interpolates.
    """
    keys = list(keys)
    present = long.filter(F.col(value).isNotNull())
    counts = present.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # every branch below needs (keys, _v, _n) and the totals, so all of them read the same shuffles
    totals = counts.groupBy(*keys).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_total")
    )
    # a group that fits into one task's window needs no bins
    binned = counts.join(totals, keys).withColumn(
        "_bin", F.expr(f"if(_total <= {small}, 0L, {_bin_number(bins)})")
    )
    per_bin = binned.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_bn"))
    ordered = Window.partitionBy(*keys).orderBy("_bin")  # at most 3 * ``bins`` rows per key
    offsets = per_bin.select(
        *keys, "_bin", (F.sum("_bn").over(ordered) - F.col("_bn")).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy("_v")
    ranks = binned.withColumn("_upto", F.sum("_n").over(inside)).join(offsets, [*keys, "_bin"])
    ranks = ranks.withColumn("_end", F.col("_before") + F.col("_upto")).withColumn(
        "_start", F.col("_end") - F.col("_n")
    )

    def at(rank):
        hit = (F.col("_start") <= rank) & (rank < F.col("_end"))
        return F.max(F.when(hit, F.col("_v")))

    aggregates = []
    for name, q in quantiles.items():
        position = F.lit(q) * (F.col("_total") - 1)
        if interpolation == "nearest":
            aggregates.append(at(F.round(position)).alias(name))
        else:
            aggregates += [
                at(F.floor(position)).alias(f"{name}__lo"),
                at(F.ceil(position)).alias(f"{name}__hi"),
                F.max(position - F.floor(position)).alias(f"{name}__w"),
            ]
    out = ranks.groupBy(*keys).agg(*aggregates)
    if interpolation == "nearest":
        return out
    return out.select(
        *keys,
        *[
            # equal neighbours need no interpolation; between infinities it would be NaN
            F.when(F.col(f"{m}__lo") == F.col(f"{m}__hi"), F.col(f"{m}__lo"))
            .otherwise(F.col(f"{m}__lo") + (F.col(f"{m}__hi") - F.col(f"{m}__lo")) * F.col(f"{m}__w"))
            .alias(m)
            for m in quantiles
        ],
    )


def sorted_quantiles(df: DataFrame, keys: Sequence[str], quantiles: dict[str, float], values: str, interpolation: str = "linear") -> DataFrame:
    """``group_quantiles`` for groups that come as one sorted array each, without NULLs and not empty."""
    out = []
    for name, q in quantiles.items():
        position = f"(double('{q!r}') * (size({values}) - 1))"
        if interpolation == "nearest":
            out.append(f"{values}[cast(round{position} as int)] as {name}")
        else:
            lo, hi = (f"{values}[cast({end}{position} as int)]" for end in ("floor", "ceil"))
            out.append(f"if({lo} = {hi}, {lo}, {lo} + ({hi} - {lo}) * ({position} - floor{position})) as {name}")
    return df.selectExpr(*keys, *out)


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``<column>__median`` over the finite values of each column."""
    finite = df.selectExpr(*[f"cast(if({text.finite(c)}, {c}, null) as double) as {c}" for c in columns])
    long = finite.unpivot([], list(columns), "kind", "value")
    medians = group_quantiles(long, ["kind"], {"median": 0.5})
    # a global aggregate: exactly one row, also when no column has a finite value
    return medians.agg(*[F.expr(f"max(if(kind = '{c}', median, null)) as {c}__median") for c in columns])
