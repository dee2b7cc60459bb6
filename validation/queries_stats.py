"""Whole-window statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sunfleet.operators import lookback as lb
from sunfleet.operators import quantiles, series, special
from sunfleet.plans import statistics as plan
from sunfleet.schema import CORE_NUMERIC

from . import sql
from .inputs import clean, telemetry
from .registry import TIE_SHIFT, query

KINDS = CORE_NUMERIC
TIES = ("etotal",)

def _long_sql(kinds):
    return " union all ".join(f"select sn, '{c}' as kind, createtime, etotal as tie, {c} as x from rows" for c in kinds)


# clean readings of the 20 days before the newest reading, in long form with positions
WINDOW = {
    "newest": "select sn, max(createtime) as newest from clean group by sn",
    "rows": "select c.* from clean c join newest using (sn) where createtime >= newest - interval 20 day and createtime < newest",
    "long": _long_sql(KINDS),
    "pos": "select *, row_number() over (partition by sn, kind order by createtime, tie) - 1 as idx, "
    "count(*) over (partition by sn, kind) as n, avg(x) over (partition by sn, kind) as mean from long",
}
#: The sum in whole units of 2^-80, so that "above the mean" does not depend on the order of a sum.
_FINE = "(abs(x)-floor(abs(x)))*1099511627776.0"
_UNITS = (
    "case when x < 0 then -1 else 1 end * (floor(abs(x))::hugeint * 1208925819614629174706176::hugeint "
    f"+ floor({_FINE})::hugeint * 1099511627776::hugeint + floor(({_FINE}-floor({_FINE}))*1099511627776.0)::hugeint)"
)
EXACT = {
    "exact": "select *, k * count(*) over (partition by sn, kind) as scaled, sum(k) over (partition by sn, kind)::hugeint as total "
    f"from (select *, {_UNITS} as k from pos)",
}
DIGITS = 6


def stats_sql(select: str, source: str = "pos", tail: str = "group by sn, kind", **extra) -> str:
    return sql.chain(f"select sn, kind, {select} from {source} {tail}", **{**WINDOW, **extra})


#: Of the wide tables, whose sums and variances run to 10^10.
WIDE_DIGITS = 4


def r(expr: str, name: str, digits: int = DIGITS) -> str:
    return sql.rnd(f"({expr}) + {TIE_SHIFT!r}::double", name, digits)


def window(spark, sf):
    return plan.window_rows(telemetry(spark, sf), 0, 20)


@query(
    "lookback_window_time",
    sql.chain(f"select sn, {sql.time()}, {sql.rnd('etotal')} from rows", **WINDOW),
)
def lookback_window_time(spark, sf):
    return window(spark, sf).select("sn", "createtime", "etotal")


@query(
    "lookback_window_time_capped",
    sql.chain(
        f"select sn, {sql.time()}, {sql.rnd('etotal')} from clean join "
        "(select sn, least(max(createtime), timestamp '2024-01-25 12:00:00') - interval 2 day as e from clean group by sn) using (sn) "
        "where createtime >= e - interval 10 day and createtime < e"
    ),
)
def lookback_window_time_capped(spark, sf):
    """Nothing after a given time is visible, and two days are left out."""
    rows = lb.rows_in_time_window(clean(spark, sf), 2, 10, dt.datetime(2024, 1, 25, 12))
    return rows.select("sn", "createtime", "etotal")


@query("ts_mean_median", stats_sql(f"{r('avg(x)', 'mean')}, {r('median(x)', 'median')}"), DIGITS, TIE_SHIFT)
def ts_mean_median(spark, sf):
    rows = series.dealt(window(spark, sf), KINDS)
    means = series.moment_features(rows, KINDS).select("sn", "kind", "mean")
    return means.join(series.median_feature(rows, KINDS), ["sn", "kind"])


@query("ts_min_max", stats_sql(f"{r('min(x)', 'min')}, {r('max(x)', 'max')}"), DIGITS, TIE_SHIFT)
def ts_min_max(spark, sf):
    return series.moment_features(window(spark, sf), KINDS).select("sn", "kind", "min", "max")


@query(
    "ts_variance_std",
    stats_sql(
        ", ".join(
            r(f"{f}(x)", n)
            for f, n in [("var_samp", "variance"), ("stddev_samp", "std"), ("var_pop", "variance_pop"), ("stddev_pop", "std_pop")]
        )
    ),
    DIGITS, TIE_SHIFT,
)
def ts_variance_std(spark, sf):
    names = ["variance", "std", "variance_pop", "std_pop"]
    return series.moment_features(window(spark, sf), KINDS).select("sn", "kind", *names)


_CENTRAL = {
    "central": "select sn, kind, any_value(n)::double as n, avg((x-mean)**2) as m2, avg((x-mean)**3) as m3, avg((x-mean)**4) as m4 from pos group by sn, kind"
}


@query(
    "ts_skewness",
    stats_sql(
        f"{r('m3/m2**1.5', 'skew')}, {r('case when n>2 then m3/m2**1.5*sqrt(n*(n-1))/(n-2) end', 'skew_adj')}",
        "central", "", **_CENTRAL,
    ),
    DIGITS, TIE_SHIFT,
)
def ts_skewness(spark, sf):
    return series.moment_features(window(spark, sf), KINDS).select("sn", "kind", "skew", "skew_adj")


@query(
    "ts_kurtosis",
    stats_sql(
        f"{r('m4/m2**2-3', 'kurtosis')}, "
        f"{r('case when n>3 then (n-1)*((n+1)*(m4/m2**2-3)+6)/((n-2)*(n-3)) end', 'kurtosis_adj')}",
        "central", "", **_CENTRAL,
    ),
    DIGITS, TIE_SHIFT,
)
def ts_kurtosis(spark, sf):
    return series.moment_features(window(spark, sf), KINDS).select("sn", "kind", "kurtosis", "kurtosis_adj")


def _position(spark, sf, which):
    return series.position_features(window(spark, sf), KINDS, [which], TIES)


@query(
    "ts_first_location_max",
    stats_sql(r("arg_min(idx, (-x, idx))::double/any_value(n)", "first_location_of_maximum")),
    DIGITS, TIE_SHIFT,
)
def ts_first_location_max(spark, sf):
    return _position(spark, sf, "first_location").drop("first_location_of_minimum")


@query(
    "ts_first_location_min",
    stats_sql(r("arg_min(idx, (x, idx))::double/any_value(n)", "first_location_of_minimum")),
    DIGITS, TIE_SHIFT,
)
def ts_first_location_min(spark, sf):
    return _position(spark, sf, "first_location").drop("first_location_of_maximum")


@query(
    "ts_count_above_below_mean",
    stats_sql(
        "cast(count_if(scaled > total) as bigint) as count_above_mean, cast(count_if(scaled < total) as bigint) as count_below_mean",
        "exact", **EXACT,
    ),
    DIGITS, TIE_SHIFT,
)
def ts_count_above_below_mean(spark, sf):
    return _position(spark, sf, "mean_counts")


_ANGLE = "2*pi()*idx/n"


@query(
    "ts_fft_coefficients",
    stats_sql(
        ", ".join(
            f"{r(f'sum(x*cos({k}*({_ANGLE})))', f'fft_real_{k}')}, {r(f'-sum(x*sin({k}*({_ANGLE})))', f'fft_imag_{k}')}"
            for k in (1, 2)
        )
    ),
    DIGITS, TIE_SHIFT,
)
def ts_fft_coefficients(spark, sf):
    return _position(spark, sf, "fft")


_TREND = (
    "select sn, kind, count(*)::double as n, regr_slope(x, idx::double) as slope, regr_intercept(x, idx::double) as intercept, "
    "regr_sxx(x, idx::double) as sxx, regr_syy(x, idx::double) as syy, regr_sxy(x, idx::double) as sxy from pos group by sn, kind"
)


@query(
    "ts_linear_trend",
    stats_sql(
        f"{r('slope', 'trend_slope')}, {r('intercept', 'trend_intercept')}, "
        f"{r('coalesce(sxy/nullif(sqrt(sxx*syy), 0), 0)', 'trend_rvalue')}, "
        f"{r('sqrt((1-coalesce(sxy/nullif(sqrt(sxx*syy), 0), 0)**2)*syy/sxx/(n-2))', 'trend_stderr')}",
        f"({_TREND})", "",
    ),
    DIGITS, TIE_SHIFT,
)
def ts_linear_trend(spark, sf):
    return _position(spark, sf, "trend").drop("trend_n")


# the series of Student's distribution, its terms in closed form
_PVALUE = {
    "trend": _TREND,
    "corr": "select *, (n - 2)::bigint as f, least(1, abs(coalesce(sxy/nullif(sqrt(sxx*syy), 0), 0))) as s from trend",
    "terms": "select sn, kind, sum(case when c2 <= 0 then (k = 0)::int::double when f % 2 = 0 then exp(k*ln(c2) + lgamma(k+0.5) - lgamma(k+1) - lgamma(0.5)) "
    "else exp(k*ln(c2) + lgamma(k+1) + lgamma(1.5) - lgamma(k+1.5)) end) as total from "
    "(select *, 1 - s*s as c2, unnest(range(0, greatest(1, (f - f % 2) // 2))) as k from (select sn, kind, f, s from corr where f > 0)) group by sn, kind",
}


@query(
    "ts_linear_trend_pvalue",
    stats_sql(
        f"{r('slope', 'trend_slope')}, {r('intercept', 'trend_intercept')}, {r('coalesce(sxy/nullif(sqrt(sxx*syy), 0), 0)', 'trend_rvalue')}, "
        f"{r('sqrt((1-coalesce(sxy/nullif(sqrt(sxx*syy), 0), 0)**2)*syy/sxx/(n-2))', 'trend_stderr')}, "
        + r("case when f % 2 = 0 then 1 - s*total when f = 1 then 1 - 2/pi()*asin(s) else 1 - 2/pi()*(asin(s) + s*sqrt(greatest(0, 1-s*s))*total) end", "trend_pvalue"),
        "corr join terms using (sn, kind)", "", **_PVALUE,
    ),
    DIGITS, TIE_SHIFT,
)
def ts_linear_trend_pvalue(spark, sf):
    """With the p-value of the slope."""
    return special.linear_trend(window(spark, sf), KINDS, TIES)


def _near(spark, sf, which):
    return series.neighbour_features(window(spark, sf), KINDS, [which], TIES)


_W = "over (partition by sn, kind order by idx)"
_NEAR = {
    "near": "select *, "
    + ", ".join(f"lead(x,{i}) {_W} as a{i}" for i in (1, 2, 3, 4))
    + ", "
    + ", ".join(f"lag(x,{i}) {_W} as b{i}" for i in (1, 2, 3))
    + " from pos"
}
_NEAR_EXACT = {**EXACT, "near": _NEAR["near"].removesuffix("pos") + "exact"}


@query("ts_abs_sum_changes", stats_sql(r("sum(abs(a1-x))", "absolute_sum_of_changes"), "near", **_NEAR), DIGITS, TIE_SHIFT)
def ts_abs_sum_changes(spark, sf):
    return _near(spark, sf, "changes")


_ACF = {
    **_NEAR,
    "acf": "select sn, kind, "
    + ", ".join(f"sum((x-mean)*(a{k}-mean))/(any_value(n)-{k})/avg((x-mean)**2) as r{k}" for k in (1, 2, 3))
    + " from near group by sn, kind",
}


@query(
    "ts_autocorrelation",
    stats_sql(", ".join(r(f"r{k}", f"autocorrelation_{k}") for k in (1, 2, 3)), "acf", "", **_ACF),
    DIGITS, TIE_SHIFT,
)
def ts_autocorrelation(spark, sf):
    return _near(spark, sf, "autocorrelation").select(
        "sn", "kind", *[f"autocorrelation_{k}" for k in (1, 2, 3)]
    )


_P2 = "((r2-r1*r1)/(1-r1*r1))"


@query(
    "ts_partial_autocorrelation",
    stats_sql(
        f"{r('r1', 'partial_autocorrelation_1')}, {r(_P2, 'partial_autocorrelation_2')}, "
        + r(
            f"(r3-(r1-{_P2}*r1)*r2-{_P2}*r1)/(1-(r1-{_P2}*r1)*r1-{_P2}*r2)", "partial_autocorrelation_3"
        ),
        "acf", "", **_ACF,
    ),
    DIGITS, TIE_SHIFT,
)
def ts_partial_autocorrelation(spark, sf):
    return _near(spark, sf, "autocorrelation").select(
        "sn", "kind", *[f"partial_autocorrelation_{k}" for k in (1, 2, 3)]
    )


@query(
    "ts_time_reversal_asymmetry",
    stats_sql(
        f"{sql.rnd('avg(a2*a2*a1 - a1*x*x)', 'time_reversal_asymmetry_1', 3)}, "
        f"{sql.rnd('avg(a4*a4*a2 - a2*x*x)', 'time_reversal_asymmetry_2', 3)}",
        "near", **_NEAR,
    ),
    3,
)
def ts_time_reversal_asymmetry(spark, sf):
    return _near(spark, sf, "reversal")


@query(
    "ts_number_peaks",
    stats_sql(
        "cast(count_if(x>a1 and x>b1) as bigint) as number_peaks_1, "
        "cast(count_if(x>a1 and x>b1 and x>a2 and x>b2 and x>a3 and x>b3) as bigint) as number_peaks_3",
        "near", **_NEAR,
    ),
    DIGITS, TIE_SHIFT,
)
def ts_number_peaks(spark, sf):
    return _near(spark, sf, "peaks")


# wavelet rows of widths 1 to 3, their local maxima, and the noise floor of the narrowest
_RICKER = "2/(sqrt(3*w)*pi()**0.25)*(1-u*u/(w*w))*exp(-u*u/(w*w)/2)"
_CWT = {
    "reach": "select p.sn, p.kind, p.idx, p.n, w.w, least(10*w.w, p.n) as k from pos p, (select unnest([1, 2, 3])::bigint as w) w",
    "parts": "select r.sn, r.kind, r.idx, r.n, r.w, b.x, b.idx as t, (r.idx + (r.k-1)//2 - b.idx) - (r.k-1)/2.0 as u "
    "from reach r join pos b on b.sn = r.sn and b.kind = r.kind and b.idx between r.idx + (r.k-1)//2 - (r.k-1) and r.idx + (r.k-1)//2",
    "wave": f"select sn, kind, idx, any_value(n) as n, w, round(sum(x*({_RICKER}) order by t), {special.DIGITS}) as y from parts group by sn, kind, idx, w",
    "tops": "select *, coalesce(y > lag(y) over v and y > lead(y) over v, false) as top from wave window v as (partition by sn, kind, w order by idx)",
    "span": "select *, (ceil(n/20.0)::bigint)//2 as half, (ceil(n/20.0)::bigint)%2 as odd from wave where w = 1",
    "floor": "select sn, kind, idx, abs(quantile_cont(y, 0.1) over (partition by sn, kind order by idx rows between half preceding and half + odd - 1 following)) as noise from span",
    "ends": "select sn, kind, idx, min(w) filter (top) as w3, bool_or(top and w = 1) as one, arg_min(abs(y), w) filter (top) as y3, max(abs(y)) filter (w = 1) as y1 from tops group by sn, kind, idx",
}


@query(
    "ts_number_cwt_peaks",
    stats_sql(
        "cast(count_if(one and y1 >= noise) as bigint) as number_cwt_peaks_1, cast(count_if(w3 is not null and y3 >= noise) as bigint) as number_cwt_peaks_3",
        "ends join floor using (sn, kind, idx)", **_CWT,
    ),
)
def ts_number_cwt_peaks(spark, sf):
    return special.number_cwt_peaks(window(spark, sf), KINDS, (1, 3), TIES)


@query(
    "ts_binned_entropy",
    stats_sql(
        r("-sum(p*ln(p))", "binned_entropy"),
        "(select sn, kind, count(*)::double/any_value(n) as p from "
        "(select *, least(floor(coalesce((x-lo)/nullif(hi-lo,0),0)*10), 9) as bin from "
        "(select *, min(x) over (partition by sn, kind) as lo, max(x) over (partition by sn, kind) as hi from pos)) "
        "group by sn, kind, bin)",
    ),
    DIGITS, TIE_SHIFT,
)
def ts_binned_entropy(spark, sf):
    return series.binned_entropy(window(spark, sf), KINDS)


@query(
    "ts_quantiles",
    stats_sql(
        ", ".join(
            r(f"quantile_cont(x, {q})", quantiles.quantile_name(q)) for q in series.QUANTILES
        )
    ),
    DIGITS, TIE_SHIFT,
)
def ts_quantiles(spark, sf):
    return series.quantile_features(window(spark, sf), KINDS)


@query(
    "ts_quantiles_nearest",
    stats_sql(
        ", ".join(
            r(f"max(case when place = round({q}::double*(n-1)) then x end)", quantiles.quantile_name(q))
            for q in series.QUANTILES
        ),
        "(select *, row_number() over (partition by sn, kind order by x) - 1 as place from pos)",
    ),
    DIGITS, TIE_SHIFT,
)
def ts_quantiles_nearest(spark, sf):
    return series.quantile_features(window(spark, sf), KINDS, interpolation="nearest")


@query(
    "ts_range_count",
    stats_sql("cast(count_if(x >= -1 and x < 1) as bigint) as range_count"),
    DIGITS, TIE_SHIFT,
)
def ts_range_count(spark, sf):
    return series.moment_features(window(spark, sf), KINDS).select("sn", "kind", "range_count")


# statistics of the wide tables, at least one of every block
_WIDE = [
    ("length", "count(x)"), ("mean", "avg(x)"), ("min", "min(x)"), ("max", "max(x)"), ("median", "median(x)"), ("variance", "var_samp(x)"), ("std_pop", "stddev_pop(x)"),
    ("range_count", "count_if(x >= -1 and x < 1)"),
    ("absolute_sum_of_changes", "sum(abs(a1-x))"), ("count_above_mean", "count_if(scaled>total)"), ("count_below_mean", "count_if(scaled<total)"),
    ("first_location_of_maximum", "arg_min(idx, (-x, idx))::double/any_value(n)"), ("first_location_of_minimum", "arg_min(idx, (x, idx))::double/any_value(n)"),
    ("trend_slope", "regr_slope(x, idx::double)"), ("trend_intercept", "regr_intercept(x, idx::double)"),
    ("number_peaks_1", "count_if(x>a1 and x>b1)"), ("number_peaks_3", "count_if(x>a1 and x>b1 and x>a2 and x>b2 and x>a3 and x>b3)"),
    *[(quantiles.quantile_name(v), f"quantile_cont(x, {v})") for v in series.QUANTILES],
    *[(f"autocorrelation_{k}", f"sum((x-mean)*(a{k}-mean))/(any_value(n)-{k})/nullif(avg((x-mean)**2), 0)") for k in (1, 2, 3)],
    ("skew", "avg((x-mean)**3)/nullif(avg((x-mean)**2), 0)**1.5"), ("kurtosis", "avg((x-mean)**4)/nullif(avg((x-mean)**2), 0)**2-3"),
    *[(f"fft_{part}_{k}", f"{sign}sum(x*{call}({k}*({_ANGLE})))") for k in (1, 2) for part, sign, call in (("real", "", "cos"), ("imag", "-", "sin"))],
]
#: What the long form fills with the median where a series is constant.
_GAPS = ("autocorrelation_1", "autocorrelation_2", "autocorrelation_3", "skew", "kurtosis")


def _wide_sql(kinds):
    cells = []
    for k in kinds:
        for name, _ in _WIDE:
            cells.append(r(f"max(case when kind='{k}' then {name} end)", f"{k}_{name}", WIDE_DIGITS))
    per = ", ".join(f"({e})::double as {n}" for n, e in _WIDE)
    return sql.chain(
        f"select sn, {', '.join(cells)} from per group by sn",
        **WINDOW, **_NEAR_EXACT, per=f"select sn, kind, {per} from near group by sn, kind",
    )


@query("window_statistics", _wide_sql(KINDS), WIDE_DIGITS, TIE_SHIFT)
def window_statistics(spark, sf):
    """All statistics in one wide row per device; the check looks at some of every block."""
    wide = plan.window_statistics(telemetry(spark, sf), KINDS, 0, 20, tie_breakers=TIES, interpolation="linear")
    return wide.select("sn", *[F.col(f"{k}_{n}").cast("double").alias(f"{k}_{n}") for k in KINDS for n, _ in _WIDE])


def _gated_sql(kinds, min_rows, min_days, wide):
    covered = (
        f"select sn from rows group by sn having count(*) >= {min_rows} and count(distinct createtime::date) >= {min_days}"
    )
    blocks = {**WINDOW, "long": f"select * from ({_long_sql(kinds)}) where sn in ({covered})"}
    filled = lambda n: f"coalesce({n}, median({n}) over (partition by kind), 0) as {n}" if n in _GAPS else n
    cells = [r(f"max(case when kind='{k}' then {name} end)", f"{k}_{name}", WIDE_DIGITS) for k in kinds for name, _ in wide]
    per = ", ".join(f"({e})::double as {n}" for n, e in wide)
    return sql.chain(
        f"select sn, {', '.join(cells)} from imputed group by sn",
        **blocks, **_NEAR_EXACT, per=f"select sn, kind, {per} from near group by sn, kind",
        imputed=f"select sn, kind, {', '.join(filled(n) for n, _ in wide)} from per",
    )


def _long_features(spark, sf, wavelet_peaks):
    return plan.window_statistics_long(
        telemetry(spark, sf), KINDS, 0, 20, min_rows=45, min_days=10, tie_breakers=TIES, wavelet_peaks=wavelet_peaks
    )


@query("window_statistics_long", _gated_sql(KINDS, 45, 10, [x for x in _WIDE if x[0] not in _GAPS]), WIDE_DIGITS, TIE_SHIFT)
def window_statistics_long(spark, sf):
    """Long form for devices with enough readings and days: statistics every series has."""
    return _long_features(spark, sf, True).select("sn", *[f"{k}_{n}" for k in KINDS for n, _ in _WIDE if n not in _GAPS])


@query("window_statistics_imputed", _gated_sql(KINDS, 45, 10, _WIDE), WIDE_DIGITS, TIE_SHIFT)
def window_statistics_imputed(spark, sf):
    """The long form with those a constant series lacks, imputed."""
    return _long_features(spark, sf, False).select("sn", *[f"{k}_{n}" for k in KINDS for n, _ in _WIDE])
