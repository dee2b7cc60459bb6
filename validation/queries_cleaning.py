"""Cleaning rules, scalar functions and device tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from sunfleet import functions as fn
from sunfleet.operators import cleaning as cl
from sunfleet.operators import fleet, lookback, ranking, reshape, sampling
from sunfleet.plans.cleaning import clean_telemetry
from sunfleet.schema import CORE_COLUMNS, CORE_NUMERIC, IPV, POWER, VAC, VPV

from . import sql
from .inputs import clean, events, fault_labels, non_finite, ok_devices, telemetry, users
from .registry import query

ID = ["sn", "createtime", "etotal"]
ID_SQL = f"sn, {sql.time()}, {sql.rnd('etotal')}"


def q(body, **extra):
    return sql.chain(body, **extra)


_TEXT_CAST = ", ".join(
    f"round(try_cast(case when (k + {i}) % 10 = 0 then 'n/a' else {c}::varchar end as double), 9) + 0.0 as {c}" for i, c in enumerate(CORE_NUMERIC)
)


@query("cast_numeric", q(f"select sn, errorcode, {sql.time()}, {_TEXT_CAST} from telemetry"))
def cast_numeric(spark, sf):
    """All metrics arrive as text here, some of it no number."""
    from sunfleet.sources.event_log import telemetry_from_events

    t = telemetry_from_events(events(spark, sf))
    text = [f"if((k + {i}) % 10 = 0, 'n/a', cast({c} as string)) as {c}" for i, c in enumerate(CORE_NUMERIC)]
    return cl.cast_numeric(t.selectExpr("sn", "errorcode", "createtime", *text))


@query("select_core", q(f"select {sql.core_out()} from telemetry"))
def select_core(spark, sf):
    from sunfleet.sources.event_log import telemetry_from_events

    return cl.select_core(telemetry_from_events(events(spark, sf)))


@query("device_prefix_filter", q(f"select {ID_SQL} from telemetry where sn like 'TP%'"))
def device_prefix_filter(spark, sf):
    return cl.device_prefix_filter(telemetry(spark, sf)).select(*ID)


_FILLED = ", ".join(f"round(coalesce({c}, 0), 9) + 0.0 as {c}" for c in CORE_NUMERIC)


@query("fill_zero", q(f"select sn, errorcode, {sql.time()}, {_FILLED} from telemetry"))
def fill_zero(spark, sf):
    return cl.fill_zero(telemetry(spark, sf))


@query("dedupe_rows", q(f"select distinct {sql.core_out()} from (select * from telemetry union all select * from telemetry where k % 3 = 0)"))
def dedupe_rows(spark, sf):
    """A third of the rows is delivered twice."""
    from sunfleet.sources.event_log import telemetry_from_events

    t = telemetry_from_events(events(spark, sf))
    return cl.dedupe_rows(cl.select_core(t.unionByName(t.filter("k % 3 = 0"))))


def _clamped(cols):
    return ", ".join(f"round(case when {c}>5000 then 0 else {c} end, 9) + 0.0 as {c}" for c in cols)


@query("clamp_ipv", q(f"select {ID_SQL}, {_clamped(IPV)} from telemetry"))
def clamp_ipv(spark, sf):
    return cl.clamp_ipv(telemetry(spark, sf).select(*ID, *IPV))


@query("clamp_vpv", q(f"select {ID_SQL}, {_clamped(VPV)} from telemetry"))
def clamp_vpv(spark, sf):
    return cl.clamp_vpv(telemetry(spark, sf).select(*ID, *VPV))


@query(
    "unwrap_reactive",
    q(
        f"select {ID_SQL}, round(case when reactivepower>16770000 then abs(reactivepower-16777216) "
        "else reactivepower end, 9) + 0.0 as reactivepower from telemetry"
    ),
)
def unwrap_reactive(spark, sf):
    return cl.unwrap_reactive(telemetry(spark, sf).select(*ID, "reactivepower"))


@query(
    "unwrap_powerfactor",
    q(
        f"select {ID_SQL}, round(case when powerfactor*powerfactor>1 then powerfactor-65.536::double "
        "else powerfactor end, 9) + 0.0 as powerfactor from telemetry"
    ),
)
def unwrap_powerfactor(spark, sf):
    return cl.unwrap_powerfactor(telemetry(spark, sf).select(*ID, "powerfactor"))


@query("drop_abnormal_devices", q(f"select {ID_SQL} from rep where sn not in (select sn from bad)"))
def drop_abnormal_devices(spark, sf):
    rows = cl.repair_sensors(cl.dedupe_rows(cl.standard_rows(telemetry(spark, sf))))
    return cl.drop_abnormal_devices(rows)[0].select(*ID)


_REASONS = " || ".join(f"case when silent_{r} then '{r};' else '' end" for r in cl.SILENT_RULES)


@query(
    "abnormal_device_list",
    q(f"select sn, {_REASONS} as reasons from reasons where sn in (select sn from bad)"),
)
def abnormal_device_list(spark, sf):
    rows = cl.repair_sensors(cl.standard_rows(telemetry(spark, sf)))
    listed = cl.abnormal_devices(rows)
    return listed.select("sn", F.array_join(F.transform("reasons", lambda r: F.concat(r, F.lit(";"))), "").alias("reasons"))


def _one_rule(rule):
    return f"select sn from reasons where silent_{rule}"


@query("device_set_union", q("select distinct sn from (" + " union all ".join(_one_rule(r) for r in cl.SILENT_RULES) + ")"))
def device_set_union(spark, sf):
    """The six abnormal sets, each found on its own, as one set."""
    profile = cl.device_profile(cl.repair_sensors(cl.standard_rows(telemetry(spark, sf))))
    sets = [profile.filter(F.array_contains("reasons", rule)) for rule in cl.SILENT_RULES]
    return reshape.device_set_union(*sets)


@query(
    "parse_createtime",
    q(f"select {ID_SQL}, {sql.time('createtime', 'parsed')} from telemetry"),
)
def parse_createtime(spark, sf):
    """Both text formats, one per half of the devices."""
    t = telemetry(spark, sf)
    first = F.date_format("createtime", "yyyy-MM-dd HH:mm:ss")
    second = F.date_format("createtime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = t.withColumn("text", F.when(F.col("etotal") % 2 == 0, first).otherwise(second))
    return text.select(*ID, fn.parse_time("text").alias("parsed"))


@query(
    "error_status",
    q(f"select {ID_SQL}, cast(case when errorcode is null then null when errorcode='0' then 0 else 1 end as bigint) as error_status from telemetry"),
)
def error_status(spark, sf):
    return telemetry(spark, sf).select(*ID, fn.error_status().alias("error_status"))


@query(
    "hour_band",
    q(
        f"select {ID_SQL}, cast(hour(createtime)>=11 as bigint) as midday from telemetry "
        "where hour(createtime)>=9 and hour(createtime)<15"
    ),
)
def hour_band(spark, sf):
    rows = telemetry(spark, sf).filter(fn.in_hours("createtime", 9, 15))
    return rows.select(*ID, fn.in_hours("createtime", 11, 15).alias("midday"))


@query("ac_on", q(f"select {ID_SQL} from telemetry where switchstatus=1"))
def ac_on(spark, sf):
    return telemetry(spark, sf).filter(fn.ac_connected()).select(*ID)


@query(
    "phase_mean_variance",
    q(
        f"select {ID_SQL}, round((vac1+vac2+vac3)/3, 9) + 0.0 as vac_horizontal_mean, "
        "round(((vac1-(vac1+vac2+vac3)/3)*(vac1-(vac1+vac2+vac3)/3) + (vac2-(vac1+vac2+vac3)/3)*(vac2-(vac1+vac2+vac3)/3) "
        "+ (vac3-(vac1+vac2+vac3)/3)*(vac3-(vac1+vac2+vac3)/3))/3, 9) + 0.0 as vac_horizontal_variance from telemetry"
    ),
)
def phase_mean_variance(spark, sf):
    return telemetry(spark, sf).select(
        *ID, fn.phase_mean(VAC).alias("vac_horizontal_mean"), fn.phase_variance(VAC).alias("vac_horizontal_variance")
    )


@query("device_in_list", q(f"select {ID_SQL} from telemetry where sn in (select sn from faults)"))
def device_in_list(spark, sf):
    return fleet.devices_in(telemetry(spark, sf), fault_labels(spark, sf)).select(*ID)


@query("device_not_in_list", q(f"select {ID_SQL} from telemetry where sn not in (select sn from faults)"))
def device_not_in_list(spark, sf):
    return fleet.devices_not_in(telemetry(spark, sf), fault_labels(spark, sf)).select(*ID)


@query(
    "device_day_lookup",
    q(f"select {ID_SQL}, errorcode from telemetry where sn='TP12KBT000B000000001' and createtime::date = date '2024-01-10'"),
)
def device_day_lookup(spark, sf):
    rows = fleet.device_day_lookup(telemetry(spark, sf), "TP12KBT000B000000001", "2024-01-10")
    return rows.select(*ID, "errorcode")


@query("device_model_prefix", q("select sn, substring(sn,1,6) as sn_prefix from users"))
def device_model_prefix(spark, sf):
    return users(spark, sf).select("sn", fn.model_prefix().alias("sn_prefix"))


@query(
    "rated_current",
    q("select sn, round(try_cast(substring(sn,3,2) as double)*1000/220/1.732::double/3, 9) + 0.0 as rated_current from users"),
)
def rated_current(spark, sf):
    return users(spark, sf).select("sn", fn.rated_current().alias("rated_current"))


_CODE = "case substring(sn,1,6) " + " ".join(f"when '{k}' then {v}" for k, v in fn.DEVICE_TYPE_CODES.items()) + " end"


@query("device_type_code", q(f"select sn, cast({_CODE} as double) + 0.0 as inverter_type_list from users"))
def device_type_code(spark, sf):
    return users(spark, sf).select("sn", fn.device_type_code().alias("inverter_type_list"))


@query(
    "device_month_key",
    q(f"select {ID_SQL}, sn || '_' || strftime(createtime, '%Y%m') as sn_ym from telemetry"),
)
def device_month_key(spark, sf):
    return telemetry(spark, sf).select(*ID, fn.month_key("sn", "createtime").alias("sn_ym"))


@query("attach_label", q("select sn, cast(error_type as bigint) as label from faults"))
def attach_label(spark, sf):
    """A constant label that the fault type then replaces."""
    return fleet.error_type_as_label(fleet.attach_label(fault_labels(spark, sf), 1))


@query(
    "cap_at_available",
    q("select sn, cast(least(60, count(*)) as bigint) as capped from telemetry group by sn"),
)
def cap_at_available(spark, sf):
    counts = telemetry(spark, sf).groupBy("sn").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("sn", fn.cap_at(F.lit(60), "n").alias("capped"))


@query(
    "head_and_rest",
    q("select sn, case when row_number() over (order by sn) <= 4 then 'head' else 'rest' end as part from users"),
)
def head_and_rest(spark, sf):
    head, rest = sampling.head_and_rest(users(spark, sf).select("sn"), ["sn"], 4)
    return head.withColumn("part", F.lit("head")).unionByName(rest.withColumn("part", F.lit("rest")))


@query(
    "find_infinite",
    q(
        f"select sn, {sql.big('etotal')}, column_name, case when value > 0 then '+' else '-' end as sign from "
        "(select sn, etotal, 'a' as column_name, a as value from non_finite union all "
        "select sn, etotal, 'b', b from non_finite union all select sn, etotal, 'c', c from non_finite) "
        "where isinf(value)"
    ),
)
def find_infinite(spark, sf):
    found = reshape.find_infinite(non_finite(spark, sf), ["sn", "etotal"], ["a", "b", "c"])
    return found.select(
        "sn", F.col("etotal").cast("bigint").alias("etotal"), "column_name",
        F.when(F.col("value") > 0, "+").otherwise("-").alias("sign"),
    )


_BAD = ", ".join(
    f"avg(case when {c} is null or {c}<=0 or {c}>6000 then 1.0::double else 0.0::double end) as {c}" for c in [*VPV, *IPV]
)


@query(
    "invalid_column_profile",
    q(
        f"select column_name, round(invalid_share, 9) + 0.0 as invalid_share from (unpivot (select {_BAD} from telemetry) "
        f"on {', '.join([*VPV, *IPV])} into name column_name value invalid_share)"
    ),
)
def invalid_column_profile(spark, sf):
    return cl.invalid_column_profile(telemetry(spark, sf))


@query(
    "row_number_index",
    q(
        f"select {ID_SQL}, row_number() over (order by {sql.md5_key('sn, etotal::bigint', 7)}) - 1 as index from telemetry"
    ),
)
def row_number_index(spark, sf):
    rows = telemetry(spark, sf).select(*ID)
    return ranking.row_number_index(rows, ["sn", F.col("etotal").cast("bigint")], seed=7)


@query("clean_telemetry", q(f"select {sql.core_out()} from clean"))
def clean_all(spark, sf):
    return clean(spark, sf)


@query(
    "last_full_day_rows",
    q(
        "select sn, strftime(date, '%Y-%m-%d') as date, "
        f"{sql.time()}, {sql.rnd('etotal')} from (select *, createtime::date as date from clean) c "
        "join (select sn, max(date) as date from (select sn, createtime::date as date, count(distinct createtime) as n "
        "from clean group by 1, 2) where n > 2 group by sn) using (sn, date)"
    ),
)
def last_full_day_rows(spark, sf):
    from sunfleet.plans.fleet import last_full_day_rows

    return last_full_day_rows(telemetry(spark, sf), 2).select("sn", "date", "createtime", "etotal")
