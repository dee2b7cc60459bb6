"""Whole-window statistics per device and metric.

Order-free statistics are plain aggregates. Order-dependent ones need the position of a reading
in its device's series and a few neighbours. Positions come from counts per device-hour, and
neighbours from chunks of consecutive positions that carry a small halo of border rows. A device
with very many readings therefore spreads over many tasks, and every value stays exact.
A device whose readings fit into one chunk needs neither: its wide rows are dealt out by device once, and its positions, neighbours and totals come from them.

Series run in ascending time; ``descending=True`` runs them from the newest reading.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact, text
from ..session import measured, written
from .quantiles import group_quantiles, quantile_name, sorted_quantiles

KEYS = ["sn", "kind"]
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
CHUNK = 1 << 15
HALO = 4  # the farthest neighbour: time reversal asymmetry at lag 2
BINS = 10


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    doubles = df.select("sn", "createtime", *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(["sn", "createtime"], list(columns), "kind", "value")


def moment_aggregates(x: str) -> list[Column]:
    """Order-free statistics, sample and population forms side by side."""
    known = {
        "length": f"count({x})",
        "mean": f"avg({x})",
        "min": f"min({x})",
        "max": f"max({x})",
        "variance": f"var_samp({x})",
        "std": f"stddev_samp({x})",
        "variance_pop": f"var_pop({x})",
        "std_pop": f"stddev_pop({x})",
        "skew": f"skewness({x})",
        "kurtosis": f"kurtosis({x})",
        "range_count": f"count_if({x} >= -1.0D and {x} < 1.0D)",
    }
    return [F.expr(a) for a in text.named(known)]


def _finish_moments(df: DataFrame) -> DataFrame:
    """Bias-corrected forms; undefined for fewer than 3 (skew) or 4 (kurtosis) readings."""
    return df.selectExpr(
        "*",
        "if(length > 2, skew * try_divide(sqrt(length * cast(length - 1 as double)), length - 2), null) as skew_adj",
        "if(length > 3, try_divide((length - 1) * ((length + 1) * kurtosis + 6.0D), "
        "cast((length - 2) * (length - 3) as double)), null) as kurtosis_adj",
    )


#: Readings with whether all their devices are short: a device's readings fit into one task.
Dealt = list[tuple[DataFrame, bool]]


def dealt(df: DataFrame | Dealt, columns: Sequence[str], tie_breakers: Sequence[str] = (), limit: int = CHUNK) -> Dealt:
    """The readings, written once with the columns in use: those of devices with at most ``limit`` of them, then the others if there are any.

    Readings without a device count as others. What is dealt already passes.
    """
    if isinstance(df, list):
        return df
    rows = written(df.select(*dict.fromkeys(["sn", "createtime", *tie_breakers, *columns])), "window-rows")
    counts = rows.groupBy(F.col("sn").alias("_sn")).agg(F.count(F.lit(1)).alias("_n"))
    long = measured(counts.filter((F.col("_n") > limit) | F.col("_sn").isNull()).select("_sn"), "long-series")
    if long.isEmpty():
        return [(rows, True)]
    same = F.col("sn").eqNullSafe(F.col("_sn"))
    return [(rows.join(long, same, "left_anti"), True), (rows.join(long, same, "left_semi"), False)]


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _doubles(columns: Sequence[str]) -> str:
    return f"array({', '.join(f'cast({c} as double)' for c in columns)})"


def moment_features(df: DataFrame | Dealt, columns: Sequence[str]) -> DataFrame:
    values = ", ".join(f"struct('{c}' as kind, cast({c} as double) as value)" for c in columns)
    parts = []
    for rows, short in dealt(df, columns):
        # a short device's rows meet before they become long rows, which then stay where they are
        long = rows.repartition("sn").selectExpr("sn", f"inline(array({values}))") if short else long_form(rows, columns)
        parts.append(long.groupBy(*KEYS).agg(*moment_aggregates("value")))
    return _finish_moments(_together(parts))


def named_quantiles(df: DataFrame | Dealt, columns: Sequence[str], quantiles: dict[str, float], interpolation: str = "linear") -> DataFrame:
    """Quantiles per (sn, kind): from the sorted readings of a short device, from value counts and bins of a long one."""
    parts = []
    for rows, short in dealt(df, columns):
        if not short:
            parts.append(group_quantiles(long_form(rows, columns), KEYS, quantiles, interpolation=interpolation))
            continue
        series = rows.selectExpr("sn", f"{_doubles(columns)} as xs").repartition("sn").groupBy("sn").agg(F.collect_list("xs").alias("_rows"))
        sorted_values = ", ".join(
            f"struct('{c}' as kind, sort_array(array_compact(transform(_rows, r -> r[{i}] + 0.0D))) as _sorted)" for i, c in enumerate(columns)
        )
        long = series.selectExpr("sn", f"inline(array({sorted_values}))").filter("size(_sorted) > 0")
        parts.append(sorted_quantiles(long, KEYS, quantiles, "_sorted", interpolation))
    return _together(parts)


def quantile_features(
    df: DataFrame | Dealt, columns: Sequence[str], quantiles: Sequence[float] = QUANTILES,
    interpolation: str = "linear",
) -> DataFrame:
    return named_quantiles(df, columns, {quantile_name(q): q for q in quantiles}, interpolation)


def median_feature(df: DataFrame | Dealt, columns: Sequence[str]) -> DataFrame:
    return named_quantiles(df, columns, {"median": 0.5})


STATS = "array<struct<place:int,mean:double,side:int,lo:double,hi:double>>"
#: What a statistic may need of a device's series besides positions.
MEAN, RANGE = "mean", "range"


def _order(tie_breakers: Sequence[str], descending: bool) -> tuple[str, str]:
    way = "desc" if descending else "asc"
    return way, ", ".join(f"{c} {way}" for c in ("createtime", *tie_breakers))


def _totals(values: dict[str, str], need: Sequence[str]) -> list[Column]:
    """Number of readings, and per metric its range and the sums behind its mean, as far as ``need`` asks for them."""
    totals = {"_n": "count(1)"}
    for c, x in values.items() if need else ():
        totals |= {f"{c}__{name}": f"{call}({x})" for name, call in (("lo", "min"), ("hi", "max"))}
        if MEAN in need:
            totals |= {f"{c}__{name}": f"{call}({x})" for name, call in (("sum", "sum"), ("cnt", "count"))}
            totals |= {f"{c}__{name}": f"sum({part})" for name, part in exact.parts(x).items()}
    return [F.expr(a) for a in text.named(totals)]


def short_rows(df: DataFrame, columns: Sequence[str], tie_breakers: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """(sn, createtime, tie breakers, xs, idx, n): readings of short devices with position and series length; ``xs`` holds the metrics."""
    _, order = _order(tie_breakers, descending)
    rows = df.selectExpr("sn", "createtime", *[f"{c} as _tie{i}" for i, c in enumerate(tie_breakers)], f"{_doubles(columns)} as xs")
    order = order.split(", ")
    order = ", ".join([order[0], *[f"_tie{i} {o.rsplit(' ', 1)[1]}" for i, o in enumerate(order[1:])]])
    placed = rows.selectExpr("*", f"row_number() over (partition by sn order by {order}) - 1 as idx", "count(1) over (partition by sn) as n")
    # readings without a time have a place, but are no part of a series
    return placed.filter("createtime is not null")


def short_series(
    df: DataFrame, columns: Sequence[str], tie_breakers: Sequence[str] = (), descending: bool = False, need: Sequence[str] = (MEAN, RANGE),
    before: int = 0, after: int = 0,
) -> DataFrame:
    """What ``with_neighbours`` yields, for devices whose readings fit into one task. Neighbours are taken of whole rows; only then a row is cut into metrics."""
    w = "over (partition by sn order by idx)"
    near = short_rows(df, columns, tie_breakers, descending).selectExpr(
        "sn", "idx", "n", "xs", *[f"lag(xs, {i}) {w} as b{i}" for i in range(1, before + 1)], *[f"lead(xs, {i}) {w} as a{i}" for i in range(1, after + 1)]
    )
    fields = [f"{name}[{{i}}] as {name}" for name in (*[f"b{i}" for i in range(1, before + 1)], *[f"a{i}" for i in range(1, after + 1)])]
    if need:
        totals = df.selectExpr("sn", f"{_doubles(columns)} as xs").repartition("sn").groupBy("sn").agg(*_totals({c: f"xs[{i}]" for i, c in enumerate(columns)}, need))
        near = near.join(_device_stats(totals, columns, need).select("sn", "stats"), "sn")
        fields += [f"stats[{{i}}].{name} as {name}" for name in ("mean", "side", "lo", "hi")]
    structs = ", ".join(f"struct({', '.join([f'{chr(39)}{c}{chr(39)} as kind', f'xs[{i}] as x', *[f.format(i=i) for f in fields]])})" for i, c in enumerate(columns))
    return near.selectExpr("sn", "idx", "n", f"inline(array({structs}))")


def indexed_rows(
    df: DataFrame, columns: Sequence[str], tie_breakers: Sequence[str] = (), descending: bool = False, need: Sequence[str] = (MEAN, RANGE)
) -> DataFrame:
    """Rows with their position ``idx`` in the device's series, its length ``n``, and ``stats``: per metric, in
    the order of ``columns``, the device's mean (see ``functions.exact``), smallest and largest value, as far as ``need`` asks for them."""
    way, order = _order(tie_breakers, descending)
    needed = dict.fromkeys(["sn", "createtime", *tie_breakers, *columns])
    rows = df.selectExpr(*needed, "date_trunc('hour', createtime) as _hour")
    hours = rows.groupBy("sn", "_hour").agg(*_totals({c: f"cast({c} as double)" for c in columns}, need))
    # one row per device-hour: bounded by the calendar, not by the number of readings
    before = f"over (partition by sn order by _hour {way} rows between unbounded preceding and 1 preceding)"
    placed = hours.selectExpr("sn", "_hour", f"coalesce(sum(_n) {before}, 0) as _before")
    numbered = rows.selectExpr(
        "*", f"row_number() over (partition by sn, _hour order by {order}) - 1 as _local"
    )
    offsets = placed.join(_device_stats(hours, columns, need), "sn")
    return numbered.join(offsets, ["sn", "_hour"]).selectExpr("*", "_before + _local as idx")


def _device_stats(hours: DataFrame, columns: Sequence[str], need: Sequence[str]) -> DataFrame:
    """(sn, n, stats) from the totals of the hours; the sums behind the means are whole numbers, equal in any order."""
    if not need:
        return hours.groupBy("sn").agg(F.expr("sum(_n) as n"), F.lit(None).cast(STATS).alias("stats"))
    calls = {"lo": "min({})", "hi": "max({})"}
    if MEAN in need:
        calls |= {"sum": "sum({})", "cnt": "sum({})", **{part: f"sum(cast({{}} as {exact.WIDE}))" for part in exact.PARTS}}
    totals = {f"{c}__{name}": call.format(f"{c}__{name}") for c in columns for name, call in calls.items()}
    device = hours.groupBy("sn").agg(F.expr("sum(_n) as n"), *[F.expr(a) for a in text.named(totals)])
    fields = lambda c: ", ".join(f"{c}__{name} as {name}" for name in calls)
    structs = ", ".join(f"struct({i} as place, {fields(c)})" for i, c in enumerate(columns))
    long = device.selectExpr("sn", "n", f"inline(array({structs}))")
    if MEAN in need:
        sums = (*exact.PARTS, "cnt")
        known = f"{exact.inside('lo')} and {exact.inside('hi')}"
        long = (
            long.selectExpr("*", f"if({known}, {exact.first_mean(*sums)}, try_divide(sum, cnt)) as first", f"{known} as known")
            .selectExpr("*", f"if(known, {exact.excess('first', *sums)}, null) as excess")
            .selectExpr("*", f"if(known, {exact.nearer_mean('first', 'excess', 'cnt')}, first) as mean")
            .selectExpr("*", f"if(known, cast(sign({exact.excess('mean', *sums)}) as int), 0) as side")
        )
    else:
        long = long.selectExpr("*", "cast(null as double) as mean", "0 as side")
    return long.groupBy("sn").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "mean", "side", "lo", "hi"))).alias("stats")
    )


def _metrics(columns: Sequence[str]) -> str:
    """One output row per metric: kind, value, and the device's mean and range of the metric."""
    structs = ", ".join(
        f"struct('{c}' as kind, cast({c} as double) as x, stats[{i}].mean as mean, stats[{i}].side as side, "
        f"stats[{i}].lo as lo, stats[{i}].hi as hi)"
        for i, c in enumerate(columns)
    )
    return f"inline(array({structs}))"


def indexed_long(
    df: DataFrame, columns: Sequence[str], tie_breakers: Sequence[str] = (), descending: bool = False, need: Sequence[str] = (MEAN, RANGE)
) -> DataFrame:
    """(sn, idx, n, kind, x, mean, side, lo, hi) per reading and metric."""
    wide = indexed_rows(df, columns, tie_breakers, descending, need)
    return wide.selectExpr("sn", "idx", "n", _metrics(columns))


def chunked(df: DataFrame, chunk: int = CHUNK, halo: int = HALO) -> DataFrame:
    """Copies every border row into the neighbouring chunk; ``core`` marks the owning chunk.

    At most ``2 * halo`` extra rows per ``chunk`` rows.
    """
    own, place = f"floor(idx / {chunk})", f"idx % {chunk}"
    targets = (
        f"array_compact(array({own}, if({place} < {halo} and {own} > 0, {own} - 1, null), "
        f"if({place} >= {chunk - halo}, {own} + 1, null)))"
    )
    return df.selectExpr("*", f"explode({targets}) as chunk").selectExpr("*", f"chunk = {own} as core")


def with_neighbours(
    df: DataFrame, columns: Sequence[str], tie_breakers: Sequence[str] = (), descending: bool = False,
    chunk: int = CHUNK, before: int = 3, after: int = 4, need: Sequence[str] = (MEAN, RANGE),
) -> DataFrame:
    """Long rows with ``b1..`` (values before) and ``a1..`` (values after); NULL past the ends."""
    rows = chunked(indexed_rows(df, columns, tie_breakers, descending, need), chunk, max(before, after, 1))
    packed = rows.repartition("sn", "chunk").selectExpr(
        "sn", "chunk", "core", "idx", "n", _metrics(columns)
    )
    # the sort is local: rows of a chunk already share a partition
    w = "over (partition by sn, chunk, kind order by idx)"
    near = packed.selectExpr(
        "*",
        *[f"lag(x, {i}) {w} as b{i}" for i in range(1, before + 1)],
        *[f"lead(x, {i}) {w} as a{i}" for i in range(1, after + 1)],
    )
    return near.filter("core").drop("chunk", "core")


def _peak(support: int) -> str:
    higher = [f"x > b{i} and x > a{i}" for i in range(1, support + 1)]
    return f"count_if({' and '.join(higher)})"


def _bin(bins: int) -> str:
    return f"least(floor(coalesce(try_divide(x - lo, hi - lo), 0.0D) * {bins}), {bins - 1})"


_ANGLE = "2.0D * pi() * idx / n"

# Statistics that need positions, but no neighbours.
POSITION = {
    "first_location": {
        "first_location_of_maximum": "min(if(x = hi, idx, null)) / cast(max(n) as double)",
        "first_location_of_minimum": "min(if(x = lo, idx, null)) / cast(max(n) as double)",
    },
    "mean_counts": {
        "count_above_mean": "count_if(x > mean or x = mean and side > 0)",
        "count_below_mean": "count_if(x < mean or x = mean and side < 0)",
    },
    "fft": {
        name: call
        for k in (1, 2)
        for name, call in (
            (f"fft_real_{k}", f"sum(x * cos({k} * ({_ANGLE})))"),
            (f"fft_imag_{k}", f"-sum(x * sin({k} * ({_ANGLE})))"),
        )
    },
    "trend": {
        "trend_slope": "regr_slope(x, cast(idx as double))",
        "trend_intercept": "regr_intercept(x, cast(idx as double))",
        "_sxx": "regr_sxx(x, cast(idx as double))",
        "_syy": "regr_syy(x, cast(idx as double))",
        "_sxy": "regr_sxy(x, cast(idx as double))",
        "trend_n": "count(x)",
    },
    "entropy": {f"_bin_{b}": f"count_if({_bin(BINS)} = {b})" for b in range(BINS)},
}

# Statistics of a value and its neighbours in time.
NEIGHBOUR = {
    "changes": {"absolute_sum_of_changes": "sum(abs(a1 - x))"},
    "autocorrelation": {
        **{f"_c{k}": f"sum((x - mean) * (a{k} - mean))" for k in (1, 2, 3)},
        "_c0": "sum((x - mean) * (x - mean))",
        "_n": "max(n)",
    },
    "reversal": {
        f"time_reversal_asymmetry_{k}": f"avg(a{2 * k} * a{2 * k} * a{k} - a{k} * x * x)" for k in (1, 2)
    },
    "peaks": {f"number_peaks_{s}": _peak(s) for s in (1, 3)},
}
NEIGHBOURS = tuple(NEIGHBOUR)
NEEDS = {"first_location": (RANGE,), "entropy": (RANGE,), "mean_counts": (MEAN,), "autocorrelation": (MEAN,)}


def _finish_trend(df: DataFrame) -> DataFrame:
    """Correlation and standard error of the slope; a constant series has correlation 0."""
    return df.selectExpr(
        "*", "if(trend_n > 1, coalesce(try_divide(_sxy, sqrt(_sxx * _syy)), 0.0D), null) as trend_rvalue"
    ).selectExpr(
        "*",
        "if(trend_n > 2, sqrt(try_divide(greatest(0.0D, 1.0D - trend_rvalue * trend_rvalue) * _syy, _sxx) "
        "/ greatest(trend_n - 2, 1)), null) as trend_stderr",
    ).drop("_sxx", "_syy", "_sxy")


def _finish_entropy(df: DataFrame) -> DataFrame:
    """Entropy of a histogram with equal-width bins between smallest and largest value."""
    names = [f"_bin_{b}" for b in range(BINS)]
    total = f"cast({' + '.join(names)} as double)"
    # -sum p ln p = ln N - (sum c ln c) / N; never negative but for rounding
    spread = " + ".join(f"if({c} > 0, {c} * ln(cast({c} as double)), 0.0D)" for c in names)
    entropy = f"greatest(ln({total}) - try_divide({spread}, {total}), 0.0D) as binned_entropy"
    return df.selectExpr("*", entropy).drop(*names)


def _finish_autocorrelation(df: DataFrame) -> DataFrame:
    """Autocorrelation at lags 1-3 and, by the Levinson-Durbin recursion, partial autocorrelation.

    NULL for a constant series and for lags the series is too short for.
    """
    scaled = [
        f"if(_n > {k}, try_divide(_c{k} * _n, _c0 * (_n - {k})), null) as autocorrelation_{k}"
        for k in (1, 2, 3)
    ]
    r1, r2, r3 = (f"autocorrelation_{k}" for k in (1, 2, 3))
    p2 = "partial_autocorrelation_2"
    p21 = f"({r1} - {p2} * {r1})"
    return (
        df.selectExpr("*", *scaled)
        .selectExpr(
            "*", f"{r1} as partial_autocorrelation_1",
            f"try_divide({r2} - {r1} * {r1}, 1.0D - {r1} * {r1}) as {p2}",
        )
        .selectExpr(
            "*",
            f"try_divide({r3} - {p21} * {r2} - {p2} * {r1}, 1.0D - {p21} * {r1} - {p2} * {r2}) "
            "as partial_autocorrelation_3",
        )
        .drop("_c0", "_c1", "_c2", "_c3", "_n")
    )


FINISH = {
    "trend": _finish_trend, "entropy": _finish_entropy, "autocorrelation": _finish_autocorrelation,
    "moments": _finish_moments,
}


def series_features(
    df: DataFrame | Dealt, columns: Sequence[str], which: Sequence[str], tie_breakers: Sequence[str] = (),
    descending: bool = False, chunk: int = CHUNK,
) -> DataFrame:
    """The chosen statistics per (sn, kind) in one pass; neighbours are computed only if needed."""
    need = sorted({n for w in which for n in NEEDS.get(w, ())})
    neighbours = any(w in NEIGHBOUR for w in which)
    known = {**POSITION, **NEIGHBOUR}
    aggregates = []
    for w in which:
        aggregates += moment_aggregates("x") if w == "moments" else [F.expr(a) for a in text.named(known[w])]
    parts = []
    for given, short in dealt(df, columns, tie_breakers, chunk):
        if short:
            rows = short_series(given, columns, tie_breakers, descending, need, *((3, 4) if neighbours else (0, 0)))
        elif neighbours:
            rows = with_neighbours(given, columns, tie_breakers, descending, chunk, need=need)
        else:
            rows = indexed_long(given, columns, tie_breakers, descending, need)
        parts.append(rows.groupBy(*KEYS).agg(*aggregates))
    out = _together(parts)
    for w in which:
        out = FINISH.get(w, lambda frame: frame)(out)
    return out


def position_features(
    df: DataFrame | Dealt, columns: Sequence[str], which: Sequence[str] = tuple(POSITION),
    tie_breakers: Sequence[str] = (), descending: bool = False,
) -> DataFrame:
    return series_features(df, columns, which, tie_breakers, descending)


def neighbour_features(
    df: DataFrame | Dealt, columns: Sequence[str], which: Sequence[str] = NEIGHBOURS,
    tie_breakers: Sequence[str] = (), descending: bool = False, chunk: int = CHUNK,
) -> DataFrame:
    return series_features(df, columns, which, tie_breakers, descending, chunk)


def binned_entropy(df: DataFrame | Dealt, columns: Sequence[str]) -> DataFrame:
    return series_features(df, columns, ["entropy"])
