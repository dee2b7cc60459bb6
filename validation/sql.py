"""Building blocks of the check SQL (one ``WITH`` chain per query)."""

from __future__ import annotations

from sunfleet.operators.cleaning import SILENT_RULES
from sunfleet.operators.daily import DEFAULTS, Thresholds, tag
from sunfleet.schema import CORE_COLUMNS, CORE_NUMERIC, IAC, IPV, PHASES, STRINGS, VAC, VPV

KW = "[10, 12, 15, 17, 20, 25, 30, 33, 36, 40]"


def d(x) -> str:
    return f"cast({x} as double)"


def sn_of(u: str) -> str:
    return (
        f"(case when {u} % 11 = 0 then 'XX' else 'TP' end || ({KW}[{u} % 10 + 1])::varchar"
        f" || 'KBT000B' || lpad({u}::varchar, 9, '0'))"
    )


def _telemetry() -> str:
    cols = {}
    for i in STRINGS:
        level = f"{d(f'(k*13+{97*i})%131')} * 10"
        if i == 6:
            level = f"case when u%3=0 then {d('(k*13+582)%15')} * 10 else {level} end"
        cols[f"vpv{i}"] = f"case when k%29={i} then {d(6553.5)} when u%13=0 then {d(0)} else {level} end"
        cols[f"ipv{i}"] = (
            f"case when k%31={i} then {d(6553.5)} when u%17=0 then {d(0)} else {d(f'(k*7+{11*i})%120')} / 10 end"
        )
    for i in PHASES:
        cols[f"vac{i}"] = d(f"170+(k*17+{5*i})%123")
        cols[f"iac{i}"] = f"case when u%19=0 then {d(0)} else {d(f'(k*3+{19*i})%61')} end"
    cols["temperature"] = f"case when k%37=0 then null else {d('20+(k*11)%45')} end"
    cols["switchstatus"] = f"case when k%7=0 then {d(0)} else {d(1)} end"
    cols["errorcode"] = (
        "case when event_type='error' then '17' when event_type='view' and k%10=0 then null else '0' end"
    )
    cols["eday"] = f"{d(f'(hour(ts)*60+minute(ts))*{KW}[u%10+1]')} / 20"
    cols["etotal"] = d("event_id")
    cols["ttotal"] = f"case when u%23=0 then {d(0)} else {d('event_id+1')} end"
    cols["activepower"] = d("k*100")
    cols["pac"] = d("k*100")
    cols["outputpowerratio"] = d("k")
    cols["inspectingpower"] = d("k*200")
    cols["reactivepower"] = f"case when k%5=0 then {d('16777216-10*k')} else {d('10*k')} end"
    cols["powerfactor"] = (
        f"case when k%9=0 and k>0 then {d(65.536)} - {d('k')}/100 else {d('k')}/100 end"
    )
    cols["fac1"] = f"{d(50)} + {d('k%5')}/100"
    cols["fac2"] = f"{d(50)} - {d('k%5')}/100"
    cols["createtime"] = "date_trunc('second', ts)::timestamp"
    cols["sn"] = sn_of("u")
    body = ", ".join(f"{cols[c]} as {c}" for c in CORE_COLUMNS)
    return f"select {body}, u, k from ev"


def _silent(rule: str) -> str:
    return "bool_and(" + " and ".join(f"coalesce({c},0)=0" for c in SILENT_RULES[rule]) + ")"


def _repaired(table: str) -> str:
    cols = []
    for c in CORE_COLUMNS:
        if c.startswith(("ipv", "vpv")):
            cols.append(f"case when {c}>5000 then {d(0)} else {c} end as {c}")
        elif c == "reactivepower":
            cols.append(f"case when {c}>16770000 then abs({c}-16777216) else {c} end as {c}")
        elif c == "powerfactor":
            cols.append(f"case when {c}*{c}>1 then {c}-{d(65.536)} else {c} end as {c}")
        else:
            cols.append(c)
    return f"select {', '.join(cols)} from {table}"


FILLED = ", ".join(f"coalesce({c},{d(0)}) as {c}" if c in CORE_NUMERIC else c for c in CORE_COLUMNS)
CORE = ", ".join(CORE_COLUMNS)

CTES: dict[str, str] = {
    "ev": "select *, user_id as u, cast(regexp_extract(props,'([0-9]+)',1) as int) as k from events",
    "telemetry": _telemetry(),
    "std": f"select {FILLED} from telemetry where sn like 'TP%'",
    "dd": f"select distinct {CORE} from std",
    "rep": _repaired("dd"),
    "reasons": "select sn, "
    + ", ".join(f"{_silent(r)} as silent_{r}" for r in SILENT_RULES)
    + " from rep group by sn",
    "bad": "select sn from reasons where " + " or ".join(f"silent_{r}" for r in SILENT_RULES),
    "clean": "select * from rep where sn not in (select sn from bad)",
    "users": f"select distinct user_id as u, {sn_of('user_id')} as sn from events",
    "faults": "select sn, case when u%4=1 then 1 else 2 end as error_type from users where u%4 in (1,3)",
    "all_labels": "select sn, case when u%4=1 then 1 when u%4=3 then 2 else 0 end as label from users",
    "ok_devices": "select sn from users where u%2=0",
    "fetch_list": "select sn, strftime(day, '%Y%m%d') as return_date from ("
    "select sn, date '2024-01-15' + (u%15)::int as day from users union all "
    "select sn, date '2024-01-15' + (u%15)::int + 3 from users where u%2=0)",
    "latest": "select sn, last(k order by createtime, etotal) as k from telemetry group by sn",
    "score_rows": f"select sn, p1 as proba_label_1, p2 as proba_label_2, 1.0::double-p1-p2 as proba_label_0 from ("
    f"select sn, {d('k%50')}/50 as p1, (1.0::double-{d('k%50')}/50)*{d('(k*7)%50')}/50 as p2 from latest)",
    "predictions": "select sn, label, (label + case when k%5=0 then 1 else 0 end)%3 as prediction "
    "from all_labels join latest using (sn)",
    "non_finite": "select sn, etotal, case when k%17=0 then 'inf'::double else vac1 end as a, "
    "case when k%19=0 then '-inf'::double when k%23=0 then 'inf'::double else iac1 end as b, "
    "case when k%29=0 then 'nan'::double else temperature end as c from telemetry",
}


def chain(body: str, **extra: str) -> str:
    """``body`` behind a WITH chain of the named blocks (unused ones cost nothing)."""
    blocks = {**CTES, **extra}
    ctes = ", ".join(f"{name} as ({sql})" for name, sql in blocks.items())
    return f"with {ctes} {body}"


def rnd(expr: str, name: str | None = None, digits: int = 9) -> str:
    return f"round({expr}, {digits}) + 0.0 as {name or expr}"


def big(expr: str, name: str | None = None) -> str:
    return f"cast({expr} as bigint) as {name or expr}"


def day(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d') as {name or expr}"


def time(expr: str = "createtime", name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') as {name or expr}"


def core_out(columns=CORE_COLUMNS, digits: int = 9) -> str:
    """Select list of core columns in comparable types."""
    out = []
    for c in columns:
        if c == "createtime":
            out.append(time(c))
        elif c in CORE_NUMERIC:
            out.append(rnd(c, digits=digits))
        else:
            out.append(c)
    return ", ".join(out)


def md5_key(columns: str, seed) -> str:
    return f"md5(concat_ws(':', {columns}, '{seed}'))"


# ---- daily features -------------------------------------------------------------------------


def _hits(cols, rated, amps, above):
    op, kind = (">", "spikes") if above else ("<", "sags")
    return {
        f"{c}_{tag(a)}_{kind}": f"count_if({c} {op} {rated * a!r}::double)" for c in cols for a in amps
    }


def daily_aggregates(family: str, t: Thresholds = DEFAULTS) -> dict[str, str]:
    on = "switchstatus=1"
    midday = f"hour(createtime)>={t.midday[0]} and hour(createtime)<{t.midday[1]}"
    band = f"hour(createtime)>={t.energy_hours[0]} and hour(createtime)<{t.energy_hours[1]}"
    rated = "try_cast(substring(sn,3,2) as double)*1000/220/1.732::double/3"

    def stats(cols):
        out = {}
        for c in cols:
            out[f"{c}_mean"] = f"avg({c}) filter (where {on})"
            out[f"{c}_variance"] = f"var_samp({c}) filter (where {on})"
        return out

    v = "(vac1+vac2+vac3)/3"
    return {
        "error": {
            "error_rate": "avg(case when errorcode is null then null when errorcode<>'0' then 1.0::double else 0.0::double end)",
            "error_occur": "max(case when errorcode<>'0' then 1 else 0 end)",
        },
        "switch": {"on_rate": "avg(switchstatus)"},
        "ipv_peaks": {f"{c}_peaks": f"max(case when {c}>{t.ipv_peak} then 1 else 0 end)" for c in IPV},
        "iac_peaks": {f"{c}_peaks": f"count_if({c} > {rated})" for c in IAC},
        "vpv_spikes": _hits(VPV, t.vpv_rated, t.vpv_spikes, True),
        "vpv_sags": _hits(VPV, t.vpv_rated, t.vpv_sags, False),
        "vac_spikes": _hits(VAC, t.vac_rated, t.vac_spikes, True),
        "vac_sags": _hits(VAC, t.vac_rated, t.vac_sags, False),
        "vac": stats(VAC),
        "vpv": stats(VPV),
        "temperature": {"temperature_mean": f"avg(temperature) filter (where {on} and {midday})"},
        "energy": {
            "eday_start": f"first(eday order by createtime, eday) filter (where {band})",
            "eday_end": f"last(eday order by createtime, eday) filter (where {band})",
            "on_rate_4_eday": f"avg(switchstatus) filter (where {band})",
        },
        "phase_imbalance": {
            "vac_horizontal_variance": "avg((" + " + ".join(f"(vac{i}-{v})*(vac{i}-{v})" for i in PHASES) + ")/3)"
        },
        "power": {"activepower_mean": f"avg(activepower) filter (where {band})"},
    }[family]


def ratio0(a: str, b: str) -> str:
    return f"coalesce(case when ({b})<>0 then ({a})/({b}) end, 0)"


def daily_blocks(
    families, out_days: int = 0, time_range: int = 7, visible: str | None = None,
    t: Thresholds = DEFAULTS, ratios: dict[str, str] | None = None, source: str = "clean",
    offsets=None,
) -> tuple[dict[str, str], list[str]]:
    """CTEs up to ``days`` (gap-filled day rows with derived columns) and their value columns.

    With ``offsets`` the windows are (sn, out_days) for every offset.
    """
    agg: dict[str, str] = {}
    for f in families:
        agg.update(daily_aggregates(f, t))
    agg.update({n: f"avg({e})" for n, e in (ratios or {}).items()})
    last = "max(createtime::date)"
    if visible:
        last = f"least({last}, date '{visible}')"
    shifts = offsets if offsets is not None else [out_days]
    blocks = {
        "seen": f"select sn, {last} as last_seen from {source} group by sn",
        "win": "select sn, out_days, last_seen - (out_days-1) as last_date, "
        f"last_seen - (out_days-1) - {time_range} as start_date from seen, "
        f"(select unnest([{', '.join(str(o) for o in shifts)}])::int as out_days)",
        "inside": f"select c.*, out_days, createtime::date as date from {source} c join win using (sn) "
        "where createtime > start_date::timestamp and createtime < last_date::timestamp",
        "daily": "select sn, out_days, date, "
        + ", ".join(f"{e} as {n}" for n, e in agg.items())
        + " from inside group by sn, out_days, date",
        "spine": f"select sn, out_days, (start_date + i::int)::date as date, i as day_idx from win, range({time_range}) r(i)",
        "joined": "select spine.*, " + ", ".join(agg) + " from spine left join daily using (sn, out_days, date)",
        "filled": "select sn, out_days, date, day_idx, "
        + ", ".join(
            f"coalesce(first_value({n} ignore nulls) over w, 0) as {n}" for n in agg
        )
        + " from joined window w as (partition by sn, out_days order by date "
        "rows between current row and unbounded following)",
    }
    extra = {}
    if "energy" in families:
        extra["eday"] = ratio0("eday_end-eday_start", "on_rate_4_eday")
    if "temperature" in families and "power" in families:
        extra["temperature_vs_power"] = ratio0("temperature_mean", "activepower_mean")
    blocks["derived"] = "select *" + "".join(f", {e} as {n}" for n, e in extra.items()) + " from filled"
    changed = []
    if "vpv" in families:
        changed += [f"vpv{i}_{m}" for m in ("mean", "variance") for i in STRINGS]
    if "vac" in families:
        changed += [f"vac{i}_{m}" for m in ("mean", "variance") for i in PHASES]
    if "temperature" in families:
        changed.append("temperature_mean")
    if "energy" in families:
        changed.append("eday")
    blocks["changed"] = (
        "select *"
        + "".join(
            f", {ratio0(f'{c}-lag({c}) over w', f'lag({c}) over w')} as {c}_change" for c in changed
        )
        + " from derived window w as (partition by sn, out_days order by date)"
    )
    idle = [f"vpv_idle_{i}" for i in STRINGS] if "vpv" in families else []
    blocks["flagged"] = (
        "select *"
        + "".join(
            f", case when max(vpv{i}_mean) over (partition by sn, out_days) < {t.vpv_noise} then 1 else 0 end as vpv_idle_{i}"
            for i in (STRINGS if idle else [])
        )
        + " from changed"
    )
    gated = [
        f"case when vpv_idle_{i}=1 then 0 else vpv{i}_{m}_change end as vpv{i}_{m}_change"
        for i in (STRINGS if idle else [])
        for m in ("mean", "variance")
    ]
    blocks["days"] = "select *" + (f" replace ({', '.join(gated)})" if gated else "") + " from flagged"
    values = [*agg, *extra, *[f"{c}_change" for c in changed], *idle]
    return blocks, values


WHOLE = ("_spikes", "_sags", "_peaks", "error_occur", "vpv_idle")


def whole_number(name: str) -> bool:
    return any(w in name for w in WHOLE)


def day_value(name: str, digits: int = 9) -> str:
    return big(name) if whole_number(name) else rnd(name, digits=digits)


def days_query(families, columns=None, where: str = "", keys=("sn",), digits: int = 9, **kw) -> str:
    blocks, values = daily_blocks(families, **kw)
    chosen = columns or values
    head = [k if k == "sn" else big(k) for k in keys]
    body = ", ".join([*head, day("date"), big("day_idx"), *[day_value(c, digits) for c in chosen]])
    return chain(f"select {body} from days {where}", **blocks)
