"""Unions, pivots, long form, struct fields and imputation of non-finite values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import text


def union_rows(first: DataFrame, second: DataFrame, keep: Sequence[str] = ("sn",)) -> DataFrame:
    """Vertical concat of frames with the same columns; all but ``keep`` become double."""

    def as_double(df):
        return df.select(
            *[F.col(c) if c in keep else F.col(c).try_cast("double").alias(c) for c in first.columns]
        )

    return as_double(first).unionByName(as_double(second))


def union_missing_ok(*frames: DataFrame) -> DataFrame:
    """Concat by name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common_columns(*frames: DataFrame) -> list[str]:
    """Columns all frames share, in the order of the first frame."""
    shared = set(frames[0].columns).intersection(*[f.columns for f in frames[1:]])
    return [c for c in frames[0].columns if c in shared]


def keep_common(*frames: DataFrame) -> list[DataFrame]:
    columns = common_columns(*frames)
    return [f.select(*columns) for f in frames]


def row_overlap(train: DataFrame, test: DataFrame, columns: Sequence[str], digits: int = 9) -> DataFrame:
    """Number of distinct rows found in both sets (leak check)."""

    def rounded(df):
        return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) for c in columns])

    return rounded(train).intersect(rounded(test)).agg(F.count(F.lit(1)).alias("overlap"))


def device_set_union(*device_lists: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.union(b), [d.select("sn") for d in device_lists]).distinct()


def pivot_days(
    days: DataFrame, cells: Sequence[tuple[str, str, int]], keys: Sequence[str] = ("sn",)
) -> DataFrame:
    """Day rows to one row per device; ``cells`` lists (output name, day-row column, day).

    A day's values travel as one array, so the aggregate has one entry per day instead of one
    per cell, and it needs no list of days from the data.
    """
    position = {c: i for i, c in enumerate(dict.fromkeys(column for _, column, _ in cells))}
    time_range = max(j for _, _, j in cells) + 1
    values = ", ".join(f"cast({c} as double)" for c in position)
    packed = days.selectExpr(*keys, "day_idx", f"array({values}) as _values")
    by_day = packed.groupBy(*keys).agg(
        *[F.expr(f"first(if(day_idx = {j}, _values, null), true) as _day_{j}") for j in range(time_range)]
    )
    return by_day.selectExpr(
        *keys, *[f"_day_{j}[{position[column]}] as `{name}`" for name, column, j in cells]
    )


def melt_long(
    df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ("sn", "createtime")
) -> DataFrame:
    return df.unpivot(list(ids), list(columns), "kind", "value")


def unnest_struct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Struct columns to plain columns ``<column>_<field>``."""
    out = []
    for name in df.columns:
        if name in columns:
            fields = df.schema[name].dataType.fieldNames()
            out += [F.col(f"{name}.{f}").alias(f"{name}_{f}") for f in fields]
        else:
            out.append(F.col(name))
    return df.select(*out)


def _one_row_join(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row aggregate; a global aggregate has exactly one row by construction."""
    return df.join(F.broadcast(stats))


def impute_infinite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``+inf`` becomes the largest other value of its column."""
    inf = F.lit(float("inf"))
    stats = df.agg(
        *[F.max(F.when(F.col(c) != inf, F.col(c))).alias(f"{c}__max") for c in columns]
    )
    joined = _one_row_join(df, stats)
    return joined.select(
        *[
            F.when(F.col(c) == inf, F.col(f"{c}__max")).otherwise(F.col(c)).alias(c)
            if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def impute_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``+inf`` -> largest, ``-inf`` -> smallest, NaN or NULL -> median of the finite values.

    A column without any finite value becomes 0. The median is exact: value counts are reduced
    per column before ranks are taken, see ``quantiles``.
    """
    from .quantiles import column_medians

    finite = {c: f"if({text.finite(c)}, {c}, null)" for c in columns}
    stats = df.agg(
        *[F.expr(f"max({v}) as {c}__max") for c, v in finite.items()],
        *[F.expr(f"min({v}) as {c}__min") for c, v in finite.items()],
    )
    joined = _one_row_join(_one_row_join(df, stats), column_medians(df, columns))
    inf = "double('infinity')"
    filled = {
        c: f"coalesce(case when {c} = {inf} then {c}__max when {c} = -{inf} then {c}__min "
        f"when {c} is null or isnan({c}) then {c}__median else {c} end, 0.0D)"
        for c in columns
    }
    return joined.selectExpr(*[f"{filled.get(c, c)} as {c}" for c in df.columns])


def feature_vectors(long: DataFrame, features: Sequence[str], keys: Sequence[str] = ("sn", "kind"), name: str = "values") -> DataFrame:
    """The features of every row of a long form as one array of doubles."""
    return long.selectExpr(*keys, f"array({', '.join(f'cast({c} as double)' for c in features)}) as {name}")


def impute_vectors(vectors: DataFrame, kind: str = "kind", name: str = "values") -> DataFrame:
    """``impute_features`` for arrays: every place of the array is a column of its own for each ``kind``.

    One aggregate over (kind, place, value) finds ends and medians, so no plan has as many columns as there are features. The
    statistics are one row per kind with as many entries as the array has: bounded by the schema, not by the rows.
    """
    from .quantiles import group_quantiles

    cells = vectors.selectExpr(kind, f"posexplode({name}) as (_place, _x)").selectExpr(kind, "_place", f"if({text.finite('_x')}, _x, null) as value")
    ends = cells.groupBy(kind, "_place").agg(F.max("value").alias("hi"), F.min("value").alias("lo"))
    medians = group_quantiles(cells, [kind, "_place"], {"median": 0.5})
    stats = ends.join(medians, [kind, "_place"], "left").groupBy(kind).agg(F.array_sort(F.collect_list(F.struct("_place", "hi", "lo", "median"))).alias("_stats"))
    inf = "double('infinity')"
    filled = (
        f"transform({name}, (x, i) -> coalesce(case when x = {inf} then _stats[i].hi when x = -{inf} then _stats[i].lo "
        "when x is null or isnan(x) then _stats[i].median else x end, 0.0D))"
    )
    joined = vectors.join(F.broadcast(stats), kind)
    return joined.selectExpr(*[f"{filled} as {c}" if c == name else c for c in vectors.columns])


def widen_vectors(
    vectors: DataFrame, kinds: Sequence[str], features: Sequence[str], key: str = "sn", kind: str = "kind", name: str = "values"
) -> DataFrame:
    """One row per ``key`` with ``<kind>_<feature>`` columns, gathered as one array of arrays."""
    order = ", ".join(f"'{k}'" for k in kinds)
    placed = vectors.selectExpr(key, f"array_position(array({order}), {kind}) as _kind", name).filter("_kind > 0")
    rows = placed.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_kind", name))).alias("_by_kind"))
    cells = [f"try_element_at(_by_kind, {i + 1}L)[{j}] as `{k}_{f}`" for i, k in enumerate(kinds) for j, f in enumerate(features)]
    return rows.selectExpr(key, *cells)


def find_infinite(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(ids, column_name, value) of every infinite cell."""
    return df.unpivot(list(ids), list(columns), "column_name", "value").filter(fn.is_infinite("value"))


def fill_scores_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing features (NULL or NaN) are 0 before scoring."""
    wanted = set(columns)
    return df.selectExpr(
        *[f"coalesce(nanvl(`{c}`, 0.0D), 0.0D) as `{c}`" if c in wanted else f"`{c}`" for c in df.columns]
    )


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema: stands in for a class that has no rows."""
    return df.filter(F.lit(False))
