"""How the stored state aggregates its days: one shuffle of the readings, one row where one will do, every way the same rows."""

import pytest
from pyspark.sql import functions as F

from sunfleet.plans import daily, incremental

DEVICES = [f"TP10KBT000B00000000{k}" for k in range(6)]


def reading(device, time, **values):
    return {"sn": DEVICES[device], "createtime": f"2024-01-{time}", **values}


def rows(df):
    return sorted((tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture()
def fleet(core_frame):
    """Six devices on three days, every reading twice; device 0 has readings at midnight, device 1 has no others on the 11th."""
    several = [
        reading(k, f"{day} {hour}:00:0{k}", vpv1=500.0 + 7 * k + int(hour), eday=float(int(hour) + k), etotal=float(100 * int(day) + 10 * int(hour) + k))
        for k in range(6) for day in ("10", "11", "12") for hour in ("08", "10", "12") if (k, day) != (1, "11")
    ]
    midnight = [reading(0, f"{day} 00:00:00", vpv1=900.0, switchstatus=0.0) for day in ("10", "11", "12")] + [reading(1, "11 00:00:00", vpv1=800.0)]
    return core_frame(*several, *midnight, *several, *midnight)


def test_two_rows_only_where_readings_lie_at_midnight(spark, tmp_path, fleet):
    root = str(tmp_path / "state")
    incremental.absorb(spark, root, fleet, "all")
    stored = spark.read.parquet(f"{root}/daily").groupBy("sn", F.dayofmonth("ds").alias("day")).agg(F.array_sort(F.collect_list(F.coalesce("day_part", F.lit(-1)))).alias("parts"))
    parts = {(r["sn"], r["day"]): r["parts"] for r in stored.collect()}
    assert parts == {(sn, day): [0] if (k, day) == (1, 11) else [0, 1] if k == 0 else [-1] for k, sn in enumerate(DEVICES) for day in (10, 11, 12)}
    for time_range in (1, 2, 7):
        assert rows(incremental.features(spark, root, time_range=time_range)) == rows(daily.daily_features(fleet, time_range=time_range))


def test_readings_are_shuffled_once(spark, tmp_path, fleet):
    root = str(tmp_path / "state")
    days = incremental.absorb(spark, root, fleet, "all")
    plan = incremental.day_rows(incremental.stored_readings(spark, root, days))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_long_days_go_by_hours(spark, tmp_path, fleet):
    root = str(tmp_path / "state")
    days = incremental.absorb(spark, root, fleet.union(fleet.filter(F.col("sn") == DEVICES[2])), "all")
    readings = incremental.stored_readings(spark, root, days)
    want = rows(incremental.day_rows(readings))
    far = incremental.long_days(readings, 8)
    assert {r["sn"] for r in far.select("sn").distinct().collect()} == {DEVICES[2]}
    for most in (0, 8, 1000):
        assert rows(incremental.day_rows(readings, long_day=most)) == want


def test_few_and_many_touched_devices(spark, tmp_path, fleet):
    once, parts = str(tmp_path / "once"), str(tmp_path / "parts")
    incremental.absorb(spark, once, fleet, "all")
    late = (F.col("sn") == DEVICES[0]) & F.col("createtime").like("% 1%")
    many = F.col("sn").isin(DEVICES[1:5]) & F.col("createtime").like("%11 12%")
    for name, rule in (("first", ~late & ~many), ("late", late), ("many", many), ("late", late)):
        incremental.absorb(spark, parts, fleet.filter(rule), name)
    assert rows(spark.read.parquet(f"{parts}/daily")) == rows(spark.read.parquet(f"{once}/daily"))
    assert rows(incremental.features(spark, parts)) == rows(daily.daily_features(fleet))
