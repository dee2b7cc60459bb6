"""Sources and sinks, device lists, joins, counts, samples and splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from sunfleet import functions as fn
from sunfleet.operators import fleet, lookback, ranking, reshape, sampling
from sunfleet.plans import fleet as fleet_plan
from sunfleet.plans import training as train_plan
from sunfleet.schema import CORE_COLUMNS, CORE_SCHEMA
from sunfleet.session import new_path
from sunfleet.sources import readers, writers

from . import sql
from .inputs import (
    all_labels, clean, events, fault_labels, fetch_list, latest_readings, non_finite, ok_devices,
    predictions, score_rows, telemetry, users,
)
from .queries_cleaning import ID, ID_SQL, q
from .registry import query


# ---- scans ------------------------------------------------------------------------------------


@query("scan_by_suffix", "select event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts from events")
def scan_by_suffix(spark, sf):
    return readers.read_file(spark, f"{sf}/events.parquet").select("event_id", "user_id", "event_type", "ts")


@query("scan_projected", "select event_id, user_id from events")
def scan_projected(spark, sf):
    return readers.read_columns(spark, f"{sf}/events.parquet", ["event_id", "user_id"])


@query("scan_folder", q(f"select {ID_SQL}, round(vac1, 9) + 0.0 as vac1 from telemetry"))
def scan_folder(spark, sf):
    """Telemetry written as several files, read back as one frame."""
    path = writers.write_parquet(telemetry(spark, sf).repartition(4), new_path(spark, "folder"))
    return readers.read_folder(spark, path, [*ID, "vac1"])


@query(
    "files_by_date_range",
    q(f"select {ID_SQL} from telemetry where createtime::date between date '2024-01-12' and date '2024-01-19'"),
)
def files_by_date_range(spark, sf):
    """Date filter on the day partitions of a daily extract."""
    path = writers.write_days(
        readers.daily_extract(telemetry(spark, sf), "20240101", "20241231", prefix=""), new_path(spark, "days")
    )
    return readers.in_date_range(spark.read.parquet(path), "20240112", "20240119").select(*ID)


_RUNS = "select distinct ts::date + 60 as run_date from events"


@query(
    "trailing_month_range",
    "select strftime(run_date, '%Y-%m-%d') as run_date, strftime(run_date - 1 - interval 1 month, '%Y%m%d') as start_day, "
    f"strftime(run_date - 1, '%Y%m%d') as end_day from ({_RUNS})",
)
def trailing_month_range(spark, sf):
    runs = events(spark, sf).select(F.date_add(F.to_date("ts"), 60).alias("run_date")).distinct()
    start, end = fn.trailing_month("run_date")
    return runs.select("run_date", start.alias("start_day"), end.alias("end_day"))


@query(
    "daily_extract",
    q(
        f"select {ID_SQL}, {sql.day('createtime', 'ds')} from telemetry where sn like 'TP%' "
        "and createtime::date between date '2024-01-05' and date '2024-01-09'"
    ),
)
def daily_extract(spark, sf):
    """Written as day partitions and read back."""
    rows = readers.daily_extract(telemetry(spark, sf), "20240105", "20240109")
    path = writers.write_days(rows, new_path(spark, "extract"))
    return spark.read.parquet(path).select(*ID, F.col("ds").cast("date").alias("ds"))


@query(
    "daily_extract_incremental",
    q(f"select {ID_SQL}, {sql.day('createtime', 'ds')} from telemetry where sn like 'TP%'"),
)
def daily_extract_incremental(spark, sf):
    """The extract as a file stream that takes what is there and stops; the second run adds nothing."""
    from sunfleet.sources.event_log import telemetry_from_events
    from sunfleet.streaming import extract

    schema = events(spark, sf).schema
    out, checkpoint = new_path(spark, "stream"), new_path(spark, "progress")
    for _ in range(2):
        arrived = extract.new_rows(spark, sf, schema, "events*.parquet")
        extract.extract_days(telemetry_from_events(arrived).select(*ID), out, checkpoint)
    return spark.read.parquet(out).select(*ID, F.col("ds").cast("date").alias("ds"))


def _fetch_sql(days):
    return q(
        f"select t.sn, {sql.time('t.createtime', 'createtime')}, {sql.rnd('t.etotal', 'etotal')}, "
        f"{sql.day('f.day', 'return_date')} from telemetry t join "
        "(select sn, min(strptime(return_date, '%Y%m%d'))::date as day from fetch_list group by sn) f on t.sn = f.sn "
        f"where t.createtime between f.day - interval {days} day and f.day::timestamp"
    )


@query("interval_fetch", _fetch_sql(10))
def interval_fetch(spark, sf):
    rows = fleet.interval_fetch(telemetry(spark, sf), fetch_list(spark, sf), 10)
    return fleet.newest_first(rows.select(*ID, "return_date"))


@query("interval_fetch_60", _fetch_sql(60))
def interval_fetch_60(spark, sf):
    return fleet.interval_fetch(telemetry(spark, sf), fetch_list(spark, sf), 60).select(*ID, "return_date")


_MANY = "select distinct sn, createtime::date as return_date from telemetry where day(createtime) % 5 = 0"


@query(
    "interval_fetch_all",
    q(
        f"select sn, {sql.time()}, {sql.rnd('etotal')}, strftime(return_date, '%Y-%m-%d') as return_date from telemetry join many using (sn) "
        "where createtime between return_date - interval 20 day and return_date",
        many=_MANY,
    ),
)
def interval_fetch_all(spark, sf):
    """Several overlapping intervals per device."""
    t = telemetry(spark, sf)
    many = t.filter("day(createtime) % 5 = 0").selectExpr("sn", "to_date(createtime) as return_date").distinct()
    return fleet.interval_fetch_all(t, many, 20).select(*ID, "return_date")


_BATCH = (
    f"select sn, cast(floor((row_number() over (order by {sql.md5_key('sn', 0)}) - 1)/20) as bigint) as batch_id "
    "from (select distinct sn from telemetry)"
)


@query("device_batches", q(_BATCH))
def device_batches(spark, sf):
    return ranking.device_batches(telemetry(spark, sf), 20)


@query("write_device_batches", q(f"select batch_id, count(*) as rows, count(distinct sn) as devices from telemetry join ({_BATCH}) using (sn) group by 1"))
def write_device_batches(spark, sf):
    path = writers.write_batches(telemetry(spark, sf), new_path(spark, "batches"), 20)
    back = spark.read.parquet(path)
    return back.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("sn").alias("devices")
    )


@query("distinct_devices", q("select distinct sn from telemetry"))
def distinct_devices(spark, sf):
    return fleet.distinct_devices(telemetry(spark, sf))


@query("sink_parquet", q(f"select {ID_SQL} from telemetry"))
def sink_parquet(spark, sf):
    path = writers.stamped_path(new_path(spark, "features"), "20240131_0000", "features")
    writers.write_parquet(telemetry(spark, sf).select(*ID), path)
    return spark.read.parquet(path)


@query("sink_csv", q(f"select {ID_SQL}, errorcode from telemetry"))
def sink_csv(spark, sf):
    path = writers.write_csv(telemetry(spark, sf).select(*ID, "errorcode"), new_path(spark, "csv"))
    return spark.read.option("header", True).schema(
        "sn string, createtime timestamp, etotal double, errorcode string"
    ).csv(path)


@query("overwrite_output", q(f"select {ID_SQL} from telemetry where etotal::bigint%2=1"))
def overwrite_output(spark, sf):
    """The second run replaces the first."""
    root = new_path(spark, "root")
    rows = telemetry(spark, sf).select(*ID)
    for rest in (0, 1):
        writers.overwrite_output(rows.filter(F.col("etotal") % 2 == rest), root, f"{root}/out")
    return spark.read.parquet(f"{root}/out")


@query("column_manifest", q(f"select {sql.rnd('vac2')}, sn, {sql.rnd('eday')} from telemetry"))
def column_manifest(spark, sf):
    path = writers.write_manifest(spark, ["vac2", "sn", "eday"], new_path(spark, "manifest"))
    return readers.project_manifest(telemetry(spark, sf), readers.read_manifest(spark, path))


# ---- joins ------------------------------------------------------------------------------------


@query("label_join", q(f"select {ID_SQL}, {sql.big('error_type')} from clean join faults using (sn)"))
def label_join(spark, sf):
    return fleet.label_join(clean(spark, sf), fault_labels(spark, sf)).select(*ID, "error_type")


_FULL = (
    "select sn, max(date) as date from (select sn, createtime::date as date, count(distinct createtime) as n "
    "from telemetry group by 1, 2) where n > 2 group by sn"
)


@query(
    "last_full_day_join",
    q(
        f"select {ID_SQL}, {sql.day('date')} from (select *, createtime::date as date from telemetry) t "
        f"join ({_FULL}) using (sn, date)"
    ),
)
def last_full_day_join(spark, sf):
    return lookback.last_full_day_join(telemetry(spark, sf), 2).select(*ID, "date")


@query("last_full_day", q(f"select sn, {sql.day('date')} from ({_FULL})"))
def last_full_day(spark, sf):
    return lookback.last_full_day(telemetry(spark, sf), 2)


@query(
    "anti_abnormal",
    q("select sn, count(*) as rows from clean group by sn"),
)
def anti_abnormal(spark, sf):
    return clean(spark, sf).groupBy("sn").agg(F.count(F.lit(1)).alias("rows"))


@query("semi_devices", q("select sn, count(*) as rows from telemetry where sn in (select sn from ok_devices) group by sn"))
def semi_devices(spark, sf):
    rows = fleet.devices_in(telemetry(spark, sf), ok_devices(spark, sf))
    return rows.groupBy("sn").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "attach_cutoff_time",
    q(
        f"select sn, {sql.rnd('proba_label_1')}, strftime(time, '%Y-%m-%d') as time from score_rows left join "
        "(select sn, max(createtime::date) + 1 as time from clean group by sn) using (sn)"
    ),
)
def attach_cutoff_time(spark, sf):
    cutoffs = lookback.device_cutoff(clean(spark, sf))
    return fleet.attach_cutoff_time(score_rows(spark, sf), cutoffs).select("sn", "proba_label_1", "time")


# ---- counts -----------------------------------------------------------------------------------


@query(
    "distinct_times_per_day",
    q(f"select sn, {sql.day('createtime', 'date')}, count(distinct createtime) as distinct_times from telemetry group by 1, 2"),
)
def distinct_times_per_day(spark, sf):
    return lookback.distinct_times_per_day(telemetry(spark, sf))


@query("min_rows_gate", q("select sn, count(*) as rows from telemetry group by sn having count(*) >= 60"))
def min_rows_gate(spark, sf):
    kept, _ = lookback.min_rows_gate(telemetry(spark, sf), 60)
    return kept.groupBy("sn").agg(F.count(F.lit(1)).alias("rows"))


@query("min_rows_skipped", q("select sn, count(*) as row_count from telemetry group by sn having count(*) < 60"))
def min_rows_skipped(spark, sf):
    return lookback.min_rows_gate(telemetry(spark, sf), 60)[1]


@query(
    "min_days_gate",
    q("select sn, count(*) as rows from telemetry group by sn having count(distinct createtime::date) >= 27"),
)
def min_days_gate(spark, sf):
    kept, _ = lookback.min_days_gate(telemetry(spark, sf), 27)
    return kept.groupBy("sn").agg(F.count(F.lit(1)).alias("rows"))


@query("count_by_model", q("select substring(sn,1,6) as sn_prefix, count(*) as count from users group by 1"))
def count_by_model(spark, sf):
    return fleet.count_by_model(users(spark, sf))


_SHARES = (
    "select sn_prefix, count, count::double / (sum(count) over ())::double as proportion from "
    "(select substring(sn,1,6) as sn_prefix, count(*) as count from ok_devices group by 1)"
)


def _quota_sql(total):
    exact = f"select *, proportion * {total}.0::double as exact_required from ({_SHARES})"
    floors = f"select *, floor(exact_required)::bigint as required_count, exact_required - floor(exact_required) as fraction from ({exact})"
    return floors


# half of the listed devices are sampled, whatever the scale
def _total(spark, sf):
    return ok_devices(spark, sf).count() // 2


@query(
    "model_proportions",
    q(
        f"select sn_prefix, count, {sql.rnd('proportion')}, {sql.rnd('exact_required')}, required_count, {sql.rnd('fraction')} "
        f"from ({_quota_sql(40)})"
    ),
)
def model_proportions(spark, sf):
    return sampling.model_proportions(ok_devices(spark, sf), 40)


def _quotas(total="(select count(*)//2 from ok_devices)"):
    exact = f"select *, proportion * ({total})::double as exact_required from ({_SHARES})"
    floors = f"select *, floor(exact_required)::bigint as base, exact_required - floor(exact_required) as fraction from ({exact})"
    return (
        "select sn_prefix, count, least(base + case when row_number() over (order by fraction desc, sn_prefix) "
        f"<= ({total}) - sum(base) over () then 1 else 0 end, count)::bigint as required_count from ({floors})"
    )


@query(
    "quota_join",
    q("select sn, substring(sn,1,6) as sn_prefix, required_count from ok_devices join quotas on substring(sn,1,6) = sn_prefix", quotas=_quotas()),
)
def quota_join(spark, sf):
    devices = ok_devices(spark, sf)
    return fleet_quota(devices, _total(spark, sf))


def fleet_quota(devices, total):
    return sampling.quota_join(devices, sampling.model_quotas(devices, total))


@query(
    "rank_in_model",
    q(
        "select sn, substring(sn,1,6) as sn_prefix, row_number() over (partition by substring(sn,1,6) "
        f"order by {sql.md5_key('sn', 42)}) as row_num from ok_devices"
    ),
)
def rank_in_model(spark, sf):
    return ranking.rank_in_model(ok_devices(spark, sf), 42)


_NUMBERED = (
    "select o.sn, q.sn_prefix, required_count, row_number() over (partition by q.sn_prefix order by "
    f"{sql.md5_key('o.sn', 42)}) as row_num from ok_devices o join quotas q on substring(o.sn,1,6) = q.sn_prefix"
)


@query(
    "proportional_sample",
    q("select sn_prefix, sn from numbered where row_num <= required_count", quotas=_quotas(), numbered=_NUMBERED),
)
def proportional_sample(spark, sf):
    devices = ok_devices(spark, sf)
    return sampling.proportional_sample(devices, _total(spark, sf), 42)


@query(
    "top_up_sample",
    q(
        "select sn from (select sn, row_number() over (order by "
        "md5(concat_ws(':', sn, 'top-up', '42'))) as r from ok_devices where sn not in (select sn from faults)) "
        "where r <= (select count(*)//3 from ok_devices)"
    ),
)
def top_up_sample(spark, sf):
    """A third of the listed devices, from those without a fault."""
    devices = ok_devices(spark, sf)
    short = devices.agg(F.floor(F.count(F.lit(1)) / 3).alias("short"))
    return sampling.top_up_sample(fleet.devices_not_in(devices, fault_labels(spark, sf)), short, 42)


def _chosen_days(days, source="telemetry"):
    return (
        "select ym, date from (select *, row_number() over (partition by ym order by date) as n, "
        f"count(*) over (partition by ym) as available from (select distinct createtime::date as date, strftime(createtime, '%Y%m') as ym from {source})) "
        "join (select ym, arg_min(n, key) as start_no from (select ym, date, row_number() over (partition by ym order by date) as n, "
        "count(*) over (partition by ym) as available, "
        f"{sql.md5_key('date', 42)} as key from (select distinct createtime::date as date, strftime(createtime, '%Y%m') as ym from {source})) "
        f"where n <= available - {days - 1} group by ym) using (ym) where n >= start_no and n < start_no + {days}"
    )


@query(
    "consecutive_days_sample",
    q(
        f"select {ID_SQL} from telemetry where sn in (select sn from ok_devices) and createtime::date in (select date from chosen)",
        chosen=_chosen_days(20),
    ),
)
def consecutive_days_sample(spark, sf):
    return sampling.consecutive_days_sample(telemetry(spark, sf), ok_devices(spark, sf), 20, seed=42).select(*ID)


@query("label_counts", q("select label, count(*) as count from all_labels group by 1"))
def label_counts(spark, sf):
    return fleet.label_counts(all_labels(spark, sf))


@query("distinct_pairs", q("select distinct sn, return_date from fetch_list"))
def distinct_pairs(spark, sf):
    return fleet.distinct_pairs(fetch_list(spark, sf))


@query("first_per_device", q("select sn, min(return_date) as return_date from fetch_list group by sn"))
def first_per_device(spark, sf):
    return fleet.first_per_device(fetch_list(spark, sf))


# ---- sorts, splits ----------------------------------------------------------------------------


@query("sort_device_time", q(f"select {ID_SQL} from telemetry order by sn, createtime"))
def sort_device_time(spark, sf):
    return fleet.sort_device_time(telemetry(spark, sf).select(*ID))


@query(
    "top_n_importance",
    q(
        "select event_type as feature, round(score / sum(score) over () * 100, 9) + 0.0 as percent from "
        "(select event_type || '_' || (u%7)::varchar as event_type, count(*)::double + (u%7)/1000.0::double as score from ev group by 1, u%7) "
        "order by percent desc, feature limit 20"
    ),
)
def top_n_importance(spark, sf):
    """On a score table of event kinds."""
    part = F.col("user_id") % 7
    scores = events(spark, sf).groupBy(F.concat_ws("_", "event_type", part.cast("string")).alias("feature"), part.alias("p")).agg(
        (F.count(F.lit(1)).cast("double")).alias("n")
    )
    return fleet.top_n_importance(scores.select("feature", (F.col("n") + F.col("p") / 1000.0).alias("score")), 20)


@query(
    "latest_version",
    q("select user_id % 5 as family, arg_max(event_type || event_id::varchar, ts) as path from ev group by 1"),
)
def latest_version(spark, sf):
    """Newest entry per family of a registry table."""
    e = events(spark, sf)
    registry = e.select(
        (F.col("user_id") % 5).alias("family"), F.col("ts").alias("modified"),
        F.concat("event_type", F.col("event_id").cast("string")).alias("path"),
    )
    return fleet.latest_version(registry, ["family"])


@query("shuffle_rows", q(f"select {ID_SQL} from telemetry"))
def shuffle_rows(spark, sf):
    return sampling.shuffle_rows(telemetry(spark, sf).select(*ID), ["sn", F.col("etotal").cast("bigint")], 42)


def _ranked(seed):
    return (
        f"select sn, label, row_number() over (partition by label order by {sql.md5_key('sn', seed)}) as r, "
        "count(*) over (partition by label) as n from all_labels"
    )


@query("stratified_split", q("select sn, label, case when r <= ceil(n*0.2::double) then 'test' else 'train' end as split from ranked", ranked=_ranked(42)))
def stratified_split(spark, sf):
    return sampling.stratified_split(all_labels(spark, sf), "label", ["sn"], 0.2, 42)


@query("per_class_split", q("select sn, label, case when r <= floor(n*0.85::double) then 'train' else 'val' end as split from ranked", ranked=_ranked(3)))
def per_class_split(spark, sf):
    return sampling.per_class_split(all_labels(spark, sf), "label", ["sn"], 0.85, 3)


@query("stratified_kfold", q("select sn, label, cast((r-1)%5 as bigint) as fold from ranked", ranked=_ranked(42)))
def stratified_kfold(spark, sf):
    return sampling.stratified_kfold(all_labels(spark, sf), "label", ["sn"], 5, 42)


# ---- set operations and reshaping -------------------------------------------------------------


@query(
    "union_rows",
    q("select sn, k::double + 0.0 as v from latest union all select sn, case when k%3=0 then null else k::double*2 end + 0.0 from latest"),
)
def union_rows(spark, sf):
    """The second frame holds text; what is no number becomes NULL."""
    rows = latest_readings(spark, sf)
    first = rows.select("sn", F.col("k").alias("v"))
    text = F.when(F.col("k") % 3 == 0, "none").otherwise((F.col("k") * 2).cast("string"))
    return reshape.union_rows(first, rows.select("sn", text.alias("v")))


@query(
    "union_missing_ok",
    q("select sn, cast(label as bigint) as label, null::bigint as k from all_labels union all select sn, null, k from latest"),
)
def union_missing_ok(spark, sf):
    return reshape.union_missing_ok(all_labels(spark, sf), latest_readings(spark, sf))


@query("common_columns", q("select sn, cast(error_type as bigint) as error_type from faults union all select sn, cast(label as bigint) from all_labels"))
def common_columns(spark, sf):
    first = fault_labels(spark, sf).withColumn("only_here", F.lit(1))
    second = all_labels(spark, sf).withColumnRenamed("label", "error_type").withColumn("other", F.lit(2))
    a, b = reshape.keep_common(first, second)
    return a.unionByName(b)


@query(
    "row_overlap",
    q(
        "select count(*) as overlap from (select round(vac1,9), round(vac2,9), round(eday,9) from telemetry where u%2=0 intersect "
        "select round(vac1,9), round(vac2,9), round(eday,9) from telemetry where u%2=1)"
    ),
)
def row_overlap(spark, sf):
    from sunfleet.sources.event_log import telemetry_from_events

    t = telemetry_from_events(events(spark, sf))
    even = F.col("user_id") % 2 == 0
    return reshape.row_overlap(t.filter(even), t.filter(~even), ["vac1", "vac2", "eday"])


@query(
    "melt_long",
    q(
        " union all ".join(
            f"select sn, {sql.time()}, '{c}' as kind, {sql.rnd(c, 'value')} from telemetry" for c in ("temperature", "vac1", "eday")
        )
    ),
)
def melt_long(spark, sf):
    return reshape.melt_long(telemetry(spark, sf), ["temperature", "vac1", "eday"])


@query(
    "unnest_struct",
    q("select sn, round(avg(vac1),9) + 0.0 as vac1_stats_mean, round(max(vac1),9) + 0.0 as vac1_stats_max from telemetry group by sn"),
)
def unnest_struct(spark, sf):
    stats = F.struct(F.avg("vac1").alias("mean"), F.max("vac1").alias("max"))
    nested = telemetry(spark, sf).groupBy("sn").agg(stats.alias("vac1_stats"))
    return reshape.unnest_struct(nested, ["vac1_stats"])


def _cells(exprs):
    return f"select sn, {sql.big('etotal')}, " + ", ".join(exprs) + " from non_finite"


def _is_nan(c):
    return f"({c} is not null and isnan({c}))"


@query(
    "impute_infinite",
    q(
        _cells(
            f"round(case when {c}='inf'::double then (select max({c}) from non_finite where {c}<>'inf'::double and not {_is_nan(c)}) else {c} end, 9) + 0.0 as {c}"
            for c in ("a",)
        )
    ),
)
def impute_infinite(spark, sf):
    out = reshape.impute_infinite(non_finite(spark, sf).select("sn", "etotal", "a"), ["a"])
    return out.withColumn("etotal", F.col("etotal").cast("bigint"))


def _imputed(c):
    finite = f"select {c} as v from non_finite where {c} is not null and isfinite({c})"
    return (
        f"round(case when {c} is null or isnan({c}) then (select median(v) from ({finite})) "
        f"when {c}='inf'::double then (select max(v) from ({finite})) "
        f"when {c}='-inf'::double then (select min(v) from ({finite})) else {c} end, 9) + 0.0 as {c}"
    )


@query("impute_features", q(_cells(_imputed(c) for c in ("a", "b", "c"))))
def impute_features(spark, sf):
    out = reshape.impute_features(non_finite(spark, sf), ["a", "b", "c"])
    return out.withColumn("etotal", F.col("etotal").cast("bigint"))


@query(
    "fill_scores_zero",
    q(_cells(["round(case when c is null or isnan(c) then 0 else c end, 9) + 0.0 as c"])),
)
def fill_scores_zero(spark, sf):
    out = reshape.fill_scores_zero(non_finite(spark, sf).select("sn", "etotal", "c"), ["c"])
    return out.withColumn("etotal", F.col("etotal").cast("bigint"))


@query("empty_like", q("select sn, cast(error_type as bigint) as error_type from faults union all select sn, label from all_labels where false"))
def empty_like(spark, sf):
    """An empty stand-in of the healthy class changes nothing in a union."""
    faults = fault_labels(spark, sf)
    return faults.unionByName(reshape.empty_like(faults))


# ---- prepared sets ----------------------------------------------------------------------------


@query("fault_set", q(f"select {ID_SQL}, sn as sn_ym from clean where sn in (select sn from faults)"))
def fault_set(spark, sf):
    """Two overlapping extracts of the faulty devices."""
    t = telemetry(spark, sf)
    rows = fleet.devices_in(t, fault_labels(spark, sf))
    first = rows.filter(F.col("createtime") < "2024-01-20")
    second = rows.filter(F.col("createtime") >= "2024-01-10")
    return fleet_plan.fault_set(first, second).select(*ID, "sn_ym")


_CHOSEN = "select sn from numbered where row_num <= required_count"
_MONTH_ROWS = "select std.* from std where sn in (select sn from sampled) and createtime::date in (select date from chosen)"


def _ok_sql():
    monthly = (
        "select sn, strftime(createtime, '%Y%m') as ym, "
        + ", ".join(f"{sql._silent(r)} as silent_{r}" for r in sql.SILENT_RULES)
        + " from month_rep group by 1, 2"
    )
    any_silent = " or ".join(f"silent_{r}" for r in sql.SILENT_RULES)
    return q(
        f"select {ID_SQL}, sn || '_' || strftime(createtime, '%Y%m') as sn_ym from month_rep "
        f"where (sn, strftime(createtime, '%Y%m')) not in (select (sn, ym) from ({monthly}) where {any_silent})",
        quotas=_quotas(), numbered=_NUMBERED, sampled=_CHOSEN, chosen=_chosen_days(20), month_rows=_MONTH_ROWS,
        month_dd="select distinct * from month_rows", month_rep=sql._repaired("month_dd"),
    )


@query("ok_set", _ok_sql())
def ok_set(spark, sf):
    devices = ok_devices(spark, sf)
    rows = fleet_plan.ok_set(telemetry(spark, sf), devices, _total(spark, sf), 20, seed=42)
    return rows.select(*ID, "sn_ym")


@query(
    "fleet_prepare",
    q(
        f"select {ID_SQL} from month_rep where sn not in (select sn from "
        "(select sn, " + ", ".join(f"{sql._silent(r)} as silent_{r}" for r in sql.SILENT_RULES) + " from month_rep group by sn) where "
        + " or ".join(f"silent_{r}" for r in sql.SILENT_RULES) + ")",
        month_dd=f"select distinct {sql.CORE} from std where createtime::date between date '2024-01-14' and date '2024-02-14'",
        month_rep=sql._repaired("month_dd"),
    ),
)
def fleet_prepare(spark, sf):
    return fleet_plan.fleet_prepare(telemetry(spark, sf), dt.date(2024, 2, 15)).select(*ID)


@query(
    "fleet_prepare_inactive",
    q(f"select {ID_SQL} from telemetry where createtime::date between date '2024-01-14' and date '2024-02-14'"),
)
def fleet_prepare_inactive(spark, sf):
    return fleet_plan.fleet_prepare(telemetry(spark, sf), dt.date(2024, 2, 15), clean=False).select(*ID)


@query(
    "split_from_saved",
    q(
        "select sn, cast(label as double) + 0.0 as label, round(v, 9) + 0.0 as v, case when r <= ceil(n*0.2::double) then 'test' else 'train' end as split from "
        "(select *, row_number() over (partition by label order by md5(concat_ws(':', sn, label::varchar || '.0', '42'))) as r, count(*) over (partition by label) as n from both_sets) "
        "union all select sn, 1.0::double, round(v, 9) + 0.0, 'train' from (select sn, v from per where u%4=3 order by sn limit 4)",
        per="select sn, max(u) as u, avg(vac1) as v from telemetry group by sn",
        both_sets="select sn, 0 as label, v from per where u%2=0 union all select sn, 1, v from per where u%4=1",
    ),
)
def split_from_saved(spark, sf):
    from sunfleet.sources.event_log import telemetry_from_events

    per = telemetry_from_events(events(spark, sf)).groupBy("sn").agg(
        F.max("user_id").alias("u"), F.avg("vac1").alias("v")
    )
    ok = per.filter("u % 2 = 0").select("sn", "v")
    fault = per.filter("u % 4 = 1").select("sn", "v", F.lit(1).alias("spare"))
    extra = per.filter("u % 4 = 3").select("v", "sn")
    return train_plan.split_from_saved(ok, fault, extra, 0.2, 42)[0]
