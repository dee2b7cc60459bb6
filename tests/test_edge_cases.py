"""Hand-made tables with expected values written by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sunfleet import functions as fn
from sunfleet.operators import changes as ch
from sunfleet.operators import cleaning as cl
from sunfleet.operators import daily as d
from sunfleet.operators import lookback as lb
from sunfleet.operators import quantiles, reshape, sampling, series
from sunfleet.plans import daily as plan
from sunfleet.plans.cleaning import clean_telemetry


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def at(day, time="12:00:00", **values):
    return {"createtime": f"2024-01-{day:02d} {time}", **values}


SN = "TP10KBT000B000000001"


def test_window_bounds_are_strict_at_midnight(core_frame):
    df = core_frame(
        at(1, "00:00:00", eday=1.0), at(1, "00:00:01", eday=2.0), at(7, "23:59:59", eday=3.0),
    )
    windows = lb.day_windows(lb.last_seen(lb.with_time(df)), 0, 7)
    assert rows(windows, "start_date", "last_date") == [(dt.date(2024, 1, 1), dt.date(2024, 1, 8))]
    inside = lb.rows_in_day_window(lb.with_time(df), windows)
    assert rows(inside, "eday") == [(2.0,), (3.0,)]


def test_reading_at_midnight_counts_inside_the_window(core_frame):
    df = core_frame(at(3, "00:00:00", eday=1.0), at(7, "10:00:00", eday=2.0))
    days = plan.daily_feature_days(df, spec=d.DailySpec(("switch",)))
    daily, _, _ = plan.windowed_rows(df, 0, 7, None)
    assert daily.count() == 2
    assert days.count() == 7


def test_out_days_and_visible_date_shift_the_window(core_frame):
    df = lb.with_time(core_frame(at(10), at(20)))
    seen = lb.last_seen(df)
    assert rows(lb.day_windows(seen, 3, 7), "start_date", "last_date") == [
        (dt.date(2024, 1, 11), dt.date(2024, 1, 18))
    ]
    assert rows(lb.day_windows(seen, 0, 7, dt.date(2024, 1, 15)), "last_date") == [(dt.date(2024, 1, 16),)]
    assert rows(lb.day_windows(seen, 0, 7, dt.date(2024, 3, 1)), "last_date") == [(dt.date(2024, 1, 21),)]


def test_gap_takes_next_day_and_trailing_gap_is_zero(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, i), v) for i, v in enumerate([None, 2.0, None, 4.0, None], 1)],
        "sn string, date date, v double",
    )
    filled = ch.backfill_then_zero(df, ["v"]).orderBy("date")
    assert [r["v"] for r in filled.collect()] == [2.0, 2.0, 4.0, 4.0, 0.0]


def test_single_reading_has_no_variance_and_borrows_the_next_days(core_frame):
    df = core_frame(
        at(6, "12:00:00", vac1=220.0), at(7, "12:00:00", vac1=200.0), at(7, "13:00:00", vac1=210.0),
    )
    days = plan.daily_feature_days(df, spec=d.DailySpec(("vac",))).orderBy("date")
    assert [r["vac1_variance"] for r in days.collect()] == [50.0] * 7


def test_change_is_zero_after_a_zero_day(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, i), v) for i, v in enumerate([0.0, 5.0, 10.0, 0.0], 1)],
        "sn string, date date, v double",
    )
    out = ch.day_over_day_change(df, ["v"]).orderBy("date")
    assert [r["v_change"] for r in out.collect()] == [0.0, 0.0, 1.0, -1.0]


def test_missing_error_code_is_neither_healthy_nor_faulty(core_frame):
    df = core_frame(
        at(7, "10:00:00", errorcode=None), at(7, "11:00:00", errorcode="0"), at(7, "12:00:00", errorcode="17"),
    )
    daily = d.daily_aggregates(lb.with_time(df), d.DailySpec(("error",)))
    assert rows(daily, "error_rate", "error_occur") == [(0.5, 1)]
    only_missing = d.daily_aggregates(lb.with_time(core_frame(at(7, errorcode=None))), d.DailySpec(("error",)))
    assert rows(only_missing, "error_rate", "error_occur") == [(None, 0)]


def test_sentinels_and_wraps(core_frame):
    df = core_frame(dict(ipv1=6553.5, vpv2=6553.5, reactivepower=16777206.0, powerfactor=65.036))
    out = cl.repair_sensors(df).first()
    assert (out["ipv1"], out["vpv2"], out["reactivepower"]) == (0.0, 0.0, 10.0)
    assert out["powerfactor"] == pytest.approx(-0.5)
    assert rows(d.daily_aggregates(lb.with_time(df), d.DailySpec(("ipv_peaks",))), "ipv1_peaks", "ipv2_peaks") == [(1, 0)]


@pytest.mark.parametrize("rule", list(cl.SILENT_RULES))
def test_each_rule_drops_a_device_on_its_own(core_frame, rule):
    silent = {c: (None if i % 2 else 0.0) for i, c in enumerate(cl.SILENT_RULES[rule])}
    bad = "TP10KBT000B000000002"
    df = core_frame(at(1), at(2), at(1, sn=bad, **silent), at(2, sn=bad, **silent))
    kept, dropped = clean_telemetry(df)
    assert {r["sn"] for r in kept.collect()} == {SN}
    assert rows(dropped, "sn", "reasons") == [(bad, [rule])]


def test_a_device_with_one_live_reading_stays(core_frame):
    kept, dropped = clean_telemetry(core_frame(at(1, ttotal=0.0), at(2, ttotal=5.0)))
    assert kept.count() == 2 and dropped.count() == 0


def test_copies_are_dropped_before_the_repair(core_frame):
    kept, _ = clean_telemetry(core_frame(at(1), at(1), at(1, ipv1=6553.5), at(1, ipv1=0.0)))
    assert kept.count() == 3


def test_foreign_devices_and_bad_numbers(spark, core_frame):
    df = core_frame(at(1, sn="XX10KBT1"), at(1)).withColumn("vac1", F.lit("n/a"))
    out = cl.standard_rows(df)
    assert rows(out, "sn", "vac1") == [(SN, 0.0)]


def test_device_codes(spark):
    df = spark.createDataFrame([("TP40KBX",), ("TP99KBX",), ("TPxxKBX",)], "sn string")
    out = df.select("sn", fn.device_type_code().alias("c"), fn.rated_current().alias("a"))
    assert rows(out)[0][:2] == ("TP40KBX", 9.0)
    assert rows(out)[0][2] == pytest.approx(40 * 1000 / 220 / 1.732 / 3)
    assert rows(out)[1][1] is None
    assert rows(out)[2][1:] == (None, None)


def test_time_formats(spark):
    df = spark.createDataFrame([("2024-01-01 02:03:04",), ("2024-01-01T02:03:04.500000",), ("soon",)], "t string")
    out = [r[0] for r in df.select(fn.parse_time("t")).collect()]
    assert out == [dt.datetime(2024, 1, 1, 2, 3, 4), dt.datetime(2024, 1, 1, 2, 3, 4, 500000), None]


def test_sample_larger_than_the_list_fails(spark):
    devices = spark.createDataFrame([("TP10KB1",), ("TP12KB1",)], "sn string")
    with pytest.raises(Exception, match="fewer than 3 devices"):
        sampling.proportional_sample(devices, 3, 1).collect()


def test_largest_remainder(spark):
    devices = spark.createDataFrame(
        [(f"TP{m}KB{i}",) for m, n in ((10, 5), (12, 3), (15, 2)) for i in range(n)], "sn string"
    )
    quotas = {r["sn_prefix"]: r["required_count"] for r in sampling.model_quotas(devices, 7).collect()}
    assert quotas == {"TP10KB": 4, "TP12KB": 2, "TP15KB": 1}
    assert sampling.proportional_sample(devices, 7, 1).distinct().count() == 7
    assert sampling.proportional_sample(devices, 10, 1).distinct().count() == 10


def test_month_with_too_few_days_is_skipped(core_frame):
    df = lb.with_time(core_frame(*[at(i) for i in (1, 2, 3, 5, 9)], {"createtime": "2024-02-01 10:00:00"}))
    chosen = rows(sampling.consecutive_days(df, 4, seed=3), "ym", "date")
    assert len(chosen) == 4 and {c[0] for c in chosen} == {"202401"}
    available = [dt.date(2024, 1, i) for i in (1, 2, 3, 5, 9)]
    assert [c[1] for c in chosen] in (available[:4], available[1:])


def test_imputation(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(1, inf, None), (2, -inf, None), (3, nan, None), (4, None, None), (5, 1.0, None), (6, 2.0, None), (7, 9.0, None)],
        "i int, v double, w double",
    )
    out = reshape.impute_features(df, ["v", "w"]).orderBy("i").collect()
    assert [r["v"] for r in out] == [9.0, 1.0, 2.0, 2.0, 1.0, 2.0, 9.0]
    assert [r["w"] for r in out] == [0.0] * 7
    only = reshape.impute_infinite(df.filter("i in (1, 5, 7)").select("i", "v"), ["v"]).orderBy("i")
    assert [r["v"] for r in only.collect()] == [9.0, 1.0, 9.0]
    assert reshape.find_infinite(df, ["i"], ["v", "w"]).count() == 2
    assert [r["v"] for r in reshape.fill_scores_zero(df, ["v"]).orderBy("i").collect()][2:4] == [0.0, 0.0]


@pytest.fixture()
def short_series(spark):
    data = []
    for sn, values in {"one": [5.0], "two": [1.0, 3.0], "three": [1.0, 4.0, 2.0], "flat": [7.0] * 6}.items():
        for i, v in enumerate(values):
            data.append((sn, dt.datetime(2024, 1, 1, 10, i), v))
    return spark.createDataFrame(data, "sn string, createtime timestamp, x double")


def test_short_and_constant_series(short_series):
    near = {r["sn"]: r for r in series.neighbour_features(short_series, ["x"]).collect()}
    assert near["one"]["absolute_sum_of_changes"] is None
    assert near["two"]["absolute_sum_of_changes"] == 2.0
    assert near["three"]["number_peaks_1"] == 1 and near["three"]["number_peaks_3"] == 0
    assert near["three"]["time_reversal_asymmetry_1"] == 2.0 * 2.0 * 4.0 - 4.0 * 1.0
    assert near["three"]["time_reversal_asymmetry_2"] is None
    assert near["flat"]["autocorrelation_1"] is None and near["two"]["autocorrelation_2"] is None
    place = {r["sn"]: r for r in series.position_features(short_series, ["x"]).collect()}
    assert place["three"]["first_location_of_maximum"] == pytest.approx(1 / 3)
    assert place["flat"]["first_location_of_minimum"] == 0.0
    assert place["flat"]["trend_slope"] == 0.0 and place["flat"]["trend_rvalue"] == 0.0
    entropy = {r["sn"]: r["binned_entropy"] for r in series.binned_entropy(short_series, ["x"]).collect()}
    assert entropy["flat"] == 0.0 and entropy["two"] == pytest.approx(0.6931471805599453)


def test_descending_order_reverses_the_series(short_series):
    down = {r["sn"]: r for r in series.position_features(short_series, ["x"], ["trend"], descending=True).collect()}
    assert down["two"]["trend_slope"] == pytest.approx(-2.0)


def test_quantiles_of_tiny_groups(short_series):
    out = {r["sn"]: r for r in series.quantile_features(short_series, ["x"]).collect()}
    assert out["one"]["quantile_0_9"] == 5.0
    assert out["two"]["quantile_0_25"] == 1.5
    nearest = {r["sn"]: r for r in series.quantile_features(short_series, ["x"], interpolation="nearest").collect()}
    assert nearest["three"]["quantile_0_9"] == 4.0


def test_time_window_excludes_the_newest_reading(core_frame):
    df = lb.with_time(core_frame(at(1), at(5), at(9)))
    assert rows(lb.rows_in_time_window(df, 0, 8).select(lb.day_of())) == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 5),)]
    capped = lb.rows_in_time_window(df, 0, 8, dt.datetime(2024, 1, 5, 12, 0, 1))
    assert capped.count() == 2


def test_idle_string_has_no_changes(core_frame):
    df = core_frame(*[at(i, vpv1=100.0 + i, vpv2=300.0 + i) for i in range(1, 8)])
    days = plan.daily_feature_days(df, spec=d.DailySpec(("vpv",))).filter("day_idx = 6").first()
    assert days["vpv_idle_1"] == 1 and days["vpv1_mean_change"] == 0.0
    assert days["vpv_idle_2"] == 0 and days["vpv2_mean_change"] == pytest.approx(1 / 306)
