"""Daily features: aggregates per family, gap fill, change, noise gate, pivot, matrices."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from sunfleet import functions as fn
from sunfleet.operators import changes as ch
from sunfleet.operators import cleaning as cl
from sunfleet.operators import daily as d
from sunfleet.operators import lookback as lb
from sunfleet.operators import reshape
from sunfleet.plans import daily as plan
from sunfleet.plans import incremental
from sunfleet.plans import scoring as score_plan
from sunfleet.plans import training as train_plan
from sunfleet.schema import IPV, PHASES, STRINGS, VAC, VPV
from sunfleet.session import new_path
from sunfleet.sources import layout
from sunfleet.sources.event_log import telemetry_from_events

from . import sql
from .inputs import clean, events, fault_labels, telemetry
from .registry import TIE_SHIFT, query


def daily_rows(spark, sf, families, out_days=0, time_range=7):
    """Aggregates of the window's days before the gap fill."""
    rows, _, _ = plan.windowed_rows(telemetry(spark, sf), out_days, time_range, None)
    return d.daily_aggregates(d.pack_by_hour(rows), d.DailySpec(tuple(families)))


def daily_sql(families, columns=None, out_days=0, time_range=7):
    blocks, values = sql.daily_blocks(families, out_days, time_range)
    values = [v for f in families for v in sql.daily_aggregates(f)]
    chosen = columns or values
    body = ", ".join(["sn", sql.day("date"), *[sql.day_value(c) for c in chosen]])
    return sql.chain(f"select {body} from daily", **blocks)


def _register_family(name, families, columns):
    @query(name, daily_sql(families, columns))
    def run(spark, sf, families=families, columns=columns):
        return daily_rows(spark, sf, families).select("sn", "date", *columns)


_register_family("error_rate", ["error"], ["error_rate"])
_register_family("error_occur", ["error"], ["error_occur"])
_register_family("vpv_spikes", ["vpv_spikes"], list(sql.daily_aggregates("vpv_spikes")))
_register_family("vpv_sags", ["vpv_sags"], list(sql.daily_aggregates("vpv_sags")))
_register_family("vac_spikes", ["vac_spikes"], list(sql.daily_aggregates("vac_spikes")))
_register_family("vac_sags", ["vac_sags"], list(sql.daily_aggregates("vac_sags")))
_register_family("iac_peaks", ["iac_peaks"], list(sql.daily_aggregates("iac_peaks")))
_register_family("midday_temperature", ["temperature"], ["temperature_mean"])
_register_family("eday_first_last", ["energy"], ["eday_start", "eday_end"])
_register_family("phase_imbalance_daily", ["phase_imbalance"], ["vac_horizontal_variance"])


@query("on_rate", daily_sql(["switch", "energy"], ["on_rate", "on_rate_4_eday"]))
def on_rate(spark, sf):
    return daily_rows(spark, sf, ["switch", "energy"]).select("sn", "date", "on_rate", "on_rate_4_eday")


@query("daily_mean_variance", daily_sql(["vac", "vpv"]))
def daily_mean_variance(spark, sf):
    return daily_rows(spark, sf, ["vac", "vpv"])


@query(
    "ipv_peaks",
    sql.chain(
        "select sn, strftime(createtime, '%Y-%m-%d') as date, "
        + ", ".join(f"cast(max(case when {c}>5000 then 1 else 0 end) as bigint) as {c}_peaks" for c in IPV)
        + " from dd group by 1, 2"
    ),
)
def ipv_peaks(spark, sf):
    """On readings whose sentinels are not repaired yet; after the repair the flags are all 0."""
    rows = cl.dedupe_rows(cl.standard_rows(telemetry(spark, sf)))
    return d.daily_aggregates(rows, d.DailySpec(("ipv_peaks",)))


@query("ipv_peaks_clean", daily_sql(["ipv_peaks"]))
def ipv_peaks_clean(spark, sf):
    return daily_rows(spark, sf, ["ipv_peaks"])


@query("merge_daily_blocks", daily_sql(["switch", "vac", "temperature", "energy"]))
def merge_daily_blocks(spark, sf):
    """The four blocks of a day in one aggregate."""
    return daily_rows(spark, sf, ["switch", "vac", "temperature", "energy"])


_JOINED, _ = sql.daily_blocks(["error", "switch"])


@query(
    "date_spine_join",
    sql.chain(
        f"select sn, {sql.day('date')}, {sql.big('day_idx')}, {sql.rnd('error_rate')}, {sql.rnd('on_rate')} from joined",
        **_JOINED,
    ),
)
def date_spine_join(spark, sf):
    rows, windows, _ = plan.windowed_rows(telemetry(spark, sf), 0, 7, None)
    daily = d.daily_aggregates(rows, d.DailySpec(("error", "switch")))
    return ch.spine_join(lb.date_spine(windows), daily).select("sn", "date", "day_idx", "error_rate", "on_rate")


_W1, _ = sql.daily_blocks(["switch"], out_days=2, visible="2024-01-25")


@query(
    "lookback_window_days",
    sql.chain(
        f"select sn, {sql.time()}, {sql.big('etotal')}, {sql.day('start_date')}, {sql.day('last_date')} "
        "from inside join win using (sn)",
        **_W1,
    ),
)
def lookback_window_days(spark, sf):
    rows = clean(spark, sf)
    windows = lb.day_windows(lb.last_seen(rows), 2, 7, dt.date(2024, 1, 25))
    inside = lb.rows_in_day_window(rows, windows)
    return inside.select("sn", "createtime", F.col("etotal").cast("bigint").alias("etotal"), "start_date", "last_date")


_CUT, _ = sql.daily_blocks(["switch"], visible="2024-01-25")


@query("device_cutoff", sql.chain(f"select sn, {sql.day('last_date', 'time')} from win", **_CUT))
def device_cutoff(spark, sf):
    return lb.device_cutoff(clean(spark, sf), 0, dt.date(2024, 1, 25))


def _days(spark, sf, families, **kw):
    return plan.daily_feature_days(telemetry(spark, sf), spec=d.DailySpec(tuple(families)), **kw)


def _register_days(name, families, columns):
    @query(name, sql.days_query(families, columns))
    def run(spark, sf, families=families, columns=columns):
        return _days(spark, sf, families).select("sn", "date", "day_idx", *columns)


_register_days("backfill_then_zero", ["error", "vac"], ["error_rate", *[f"{c}_variance" for c in VAC]])
_register_days("midday_energy", ["energy"], ["eday_start", "eday_end", "on_rate_4_eday", "eday"])
_register_days(
    "day_over_day_change",
    ["vac", "temperature", "energy"],
    [*[f"{c}_{m}_change" for c in VAC for m in ("mean", "variance")], "temperature_mean_change", "eday_change"],
)
_register_days(
    "string_noise_gate",
    ["vpv"],
    [f"{c}_{m}_change" for c in VPV for m in ("mean", "variance")],
)


@query(
    "string_at_work",
    sql.chain(
        "select distinct sn, "
        + ", ".join(f"cast(vpv_idle_{i} as bigint) as vpv_idle_{i}, cast(1-vpv_idle_{i} as bigint) as vpv_at_work_{i}" for i in STRINGS)
        + " from days",
        **sql.daily_blocks(["vpv"], t=d.DRAFT)[0],
    ),
)
def string_at_work(spark, sf):
    spec = d.DailySpec(("vpv",), d.DRAFT)
    days = plan.daily_feature_days(telemetry(spark, sf), spec=spec).filter(F.col("day_idx") == 0)
    flags = [f"{p}_{i}" for i in STRINGS for p in ("vpv_idle", "vpv_at_work")]
    return ch.string_at_work(days).select("sn", *flags)


@query(
    "temp_vs_power",
    sql.days_query(["temperature", "power"], ["temperature_mean", "activepower_mean", "temperature_vs_power"]),
)
def temp_vs_power(spark, sf):
    days = _days(spark, sf, ["temperature", "power"])
    return days.select("sn", "date", "day_idx", "temperature_mean", "activepower_mean", "temperature_vs_power")


PAIRS = [(1, 2), (3, 4), (5, 6)]


def ratio_columns():
    out = {}
    for i, j in PAIRS:
        vac, iac = f"vac{(i + 1) // 2}", f"iac{(i + 1) // 2}"
        vpv = F.col(f"vpv{i}") + F.col(f"vpv{j}")
        ipv = F.col(f"ipv{i}") + F.col(f"ipv{j}")
        out[f"vac_vpv_ratio_{i}{j}"] = fn.ratio_or_zero(F.col(vac), vpv)
        out[f"iac_ipv_ratio_{i}{j}"] = fn.ratio_or_zero(F.col(iac), ipv)
    return out


def ratio_sql():
    out = {}
    for i, j in PAIRS:
        p = (i + 1) // 2
        out[f"vac_vpv_ratio_{i}{j}"] = sql.ratio0(f"vac{p}", f"vpv{i}+vpv{j}")
        out[f"iac_ipv_ratio_{i}{j}"] = sql.ratio0(f"iac{p}", f"ipv{i}+ipv{j}")
    return out


@query("ratio_daily_mean", sql.days_query([], list(ratio_sql()), ratios=ratio_sql()))
def ratio_daily_mean(spark, sf):
    """The ratios are the caller's: here each phase against its pair of strings."""
    spec = d.DailySpec((), ratios=ratio_columns())
    return plan.daily_feature_days(telemetry(spark, sf), spec=spec)


@query(
    "first_difference",
    sql.chain(
        f"select sn, {sql.day('date')}, {sql.rnd('on_rate')}, "
        f"{sql.rnd('on_rate - lag(on_rate) over (partition by sn order by date)', 'on_rate_diff')} from days",
        **sql.daily_blocks(["switch"])[0],
    ),
)
def first_difference(spark, sf):
    days = _days(spark, sf, ["switch"])
    return ch.first_difference(days, ["on_rate"]).select("sn", "date", "on_rate", "on_rate_diff")


def pivot_sql(families, columns, keys=("sn",), extra_select="", digits=9, **kw):
    """Check SQL of a feature matrix: one conditional maximum per (column, day)."""
    blocks, _ = sql.daily_blocks(families, **kw)
    cells = [
        f"round(max(case when day_idx={j} then {column} end)::double, {digits}) + 0.0 as {plan.safe_name(name)}"
        for name, column, j in columns
    ]
    head = [k if k == "sn" else sql.big(k) for k in keys]
    group = ", ".join(keys)
    return sql.chain(
        f"select {', '.join([*head, *cells])}{extra_select} from days group by {group}", **blocks
    )


def matrix_part(prefixes, time_range=7, t=d.DEFAULTS, draft=False):
    columns = plan.matrix_columns(time_range, t, draft)
    return [c for c in columns if any(c[1].startswith(p) for p in prefixes)]


_PIVOT = plan.matrix_columns()


@query("pivot_days", pivot_sql(list(d.FAMILIES), _PIVOT))
def pivot_days(spark, sf):
    return plan.matrix_from_days(_days(spark, sf, list(d.FAMILIES)), _PIVOT)


@query("daily_features", pivot_sql(list(d.FAMILIES), plan.matrix_columns()))
def daily_features(spark, sf):
    """The whole feature matrix: 631 features per device."""
    return plan.daily_features(telemetry(spark, sf))


@query("daily_features_incremental", pivot_sql(list(d.FAMILIES), plan.matrix_columns()))
def daily_features_incremental(spark, sf):
    """The same matrix from a stored state: three interleaved deliveries, one of them again with others' rows, all days touched late."""
    t, root = telemetry_from_events(events(spark, sf)), new_path(spark, "daily-state")
    for name, rule in (("b0", "k % 3 = 0"), ("b1", "k % 3 = 1"), ("b2", "k % 3 = 2 and day(createtime) % 2 = 0"), ("b1", "k % 3 = 1"), ("b3", "k % 3 = 2 or k % 9 = 0")):
        incremental.absorb(spark, root, t.filter(rule), name)
    return incremental.features(spark, root)


@query("daily_features_of_table", pivot_sql(list(d.FAMILIES), plan.matrix_columns()))
def daily_features_of_table(spark, sf):
    """The same matrix from a table partitioned by day and bucketed by device."""
    table = layout.write_device_table(telemetry(spark, sf), f"readings_{uuid.uuid4().hex}", 8)
    devices = layout.profile(spark, table).filter("size(reasons) = 0").select("sn", "last_seen")
    daily, windows = layout.daily_aggregates(spark, table, devices)
    return plan.matrix_from_days(plan.complete_days(ch.spine_join(lb.date_spine(windows), daily)), plan.matrix_columns())


@query(
    "daily_features_shifted",
    pivot_sql(list(d.FAMILIES), plan.matrix_columns(5), out_days=3, time_range=5, visible="2024-01-28"),
)
def daily_features_shifted(spark, sf):
    """Other window: 5 days, 3 days back, nothing visible after a given day."""
    days = _days(spark, sf, list(d.FAMILIES), out_days=3, time_range=5, visible_date=dt.date(2024, 1, 28))
    return plan.matrix_from_days(days, plan.matrix_columns(5))


_DRAFT_FAMILIES = [*d.FAMILIES, *d.DRAFT_FAMILIES]
_DRAFT_COLUMNS = (
    plan.matrix_columns(7, d.DRAFT, draft=True)
    + [(f"vpv_idle_{i}", f"vpv_idle_{i}", 0) for i in STRINGS]
    + [(f"{n}_day_{j}", n, j) for n in ratio_sql() for j in range(7)]
)


@query("daily_features_ext", pivot_sql(_DRAFT_FAMILIES, _DRAFT_COLUMNS, t=d.DRAFT, ratios=ratio_sql()))
def daily_features_ext(spark, sf):
    return plan.daily_features_ext(telemetry(spark, sf), ratios=ratio_columns())


_T30 = plan.matrix_columns(30)
TYPE_CODE = "case substring(sn,1,6) " + " ".join(
    f"when '{k}' then {v}" for k, v in fn.DEVICE_TYPE_CODES.items()
) + " end"


def long_matrix_sql(columns, **kw):
    """Check SQL of a feature matrix in long form (sn, feature, value), with the model code."""
    blocks, _ = sql.daily_blocks(list(d.FAMILIES), **kw)
    used = list(dict.fromkeys(c for _, c, _ in columns))
    names = ", ".join(f"('{plan.safe_name(n)}', '{c}', {j})" for n, c, j in columns)
    blocks["named"] = f"select * from (values {names}) t(feature, col, day_idx)"
    blocks["flat"] = f"select sn, day_idx, {', '.join(f'{c}::double as {c}' for c in used)} from days"
    blocks["cells"] = f"select * from flat unpivot include nulls (x for col in ({', '.join(used)}))"
    return sql.chain(
        f"select sn, feature, {sql.rnd(f'x + {TIE_SHIFT!r}::double', 'value', 6)} from cells join named using (col, day_idx) "
        f"union all select distinct sn, 'inverter_type_list', {sql.rnd(f'cast({TYPE_CODE} as double) + {TIE_SHIFT!r}::double', 'value', 6)} from days", **blocks,
    )


@query("score_single_file", long_matrix_sql(_T30, time_range=30), 6, TIE_SHIFT)
def score_single_file(spark, sf):
    """30-day features of one file, of all families and with the model code, as (sn, feature, value)."""
    wide = score_plan.score_features(telemetry(spark, sf), None, 30)[0]
    features = [c for c in wide.columns if c != "sn"]
    names = ", ".join(f"'{c}'" for c in features)
    cells = wide.selectExpr("sn", f"posexplode(array({', '.join(f'cast({c} as double)' for c in features)})) as (place, value)")
    return cells.selectExpr("sn", f"array({names})[place] as feature", "value")


_OFFSET_FAMILIES = list(d.FAMILIES)
_OFFSET_COLUMNS = plan.matrix_columns()


def offset_sql(final: str, columns=_OFFSET_COLUMNS, families=_OFFSET_FAMILIES) -> str:
    blocks, _ = sql.daily_blocks(families, offsets=list(range(8)))
    cells = ", ".join(
        f"round(max(case when day_idx={j} then {column} end)::double, 9) + 0.0 as {plan.safe_name(name)}"
        for name, column, j in columns
    )
    names = ", ".join(plan.safe_name(n) for n, _, _ in columns)
    wide = f"select sn, out_days, {cells} from days group by sn, out_days"
    rows = (
        f"select sn, out_days, 0 as copy, error_type as label, {names} from wide join faults using (sn) union all "
        f"select sn, out_days, 0, 0, {names} from wide where out_days=0 and sn not in (select sn from faults)"
    )
    return sql.chain(final, **blocks, wide=wide, rows=rows)


_OFFSET_NAMES = [plan.safe_name(n) for n, _, _ in _OFFSET_COLUMNS]


@query(
    "offset_augmentation",
    offset_sql(
        f"select sn, {sql.big('out_days')}, {sql.big('copy')}, {sql.big('label')}, {', '.join(_OFFSET_NAMES)} from rows"
    ),
)
def offset_augmentation(spark, sf):
    """Eight shifted windows per faulty device, one per healthy device."""
    t, labels = telemetry(spark, sf), fault_labels(spark, sf)
    ok = t.join(labels, "sn", "left_anti")
    fault = t.join(labels, "sn", "left_semi")
    spec = d.DailySpec(tuple(_OFFSET_FAMILIES))
    return train_plan.offset_augmentation(ok, fault, labels, spec=spec, features=_OFFSET_NAMES)


@query(
    "training_matrix",
    offset_sql(
        f"select sn, {sql.big('out_days')}, {sql.big('copy')}, {sql.big('label')}, {', '.join(_OFFSET_NAMES)}, "
        f"round(cast({TYPE_CODE} as double), 9) + 0.0 as inverter_type_list, "
        "case when row_number() over (partition by label order by md5(concat_ws(':', sn, out_days, copy, '42'))) "
        "<= ceil(count(*) over (partition by label) * 0.2::double) then 'test' else 'train' end as split from rows"
    ),
)
def training_matrix(spark, sf):
    t, labels = telemetry(spark, sf), fault_labels(spark, sf)
    ok = t.join(labels, "sn", "left_anti")
    fault = t.join(labels, "sn", "left_semi")
    spec = d.DailySpec(tuple(_OFFSET_FAMILIES))
    return train_plan.training_matrix(ok, fault, labels, 0.2, 42, spec=spec, features=_OFFSET_NAMES)
