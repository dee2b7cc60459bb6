"""The laid-out table: what its plans read and where they shuffle."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from sunfleet.operators import daily as d
from sunfleet.plans import daily as plan
from sunfleet.sources import layout
from sunfleet.sources.event_log import read_telemetry


@pytest.fixture(scope="module")
def readings(spark):
    return read_telemetry(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def table(spark, readings):
    name = layout.write_device_table(readings.filter("etotal % 2 = 0"), f"t_{uuid.uuid4().hex}", 4)
    layout.append_days(readings.filter("etotal % 2 = 1"), name)
    yield name
    spark.sql(f"drop table {name}")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_and_buckets_are_pruned(spark, table, readings):
    sn, day = readings.filter("sn like 'TP%'").selectExpr("sn", "to_date(createtime)").orderBy("etotal").first()
    found = layout.device_rows(spark, table, sn, day)
    automatic = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(automatic, "false")  # the plan names the buckets of a bucketed scan only
    text = plan_text(layout.device_rows(spark, table, sn, day))
    spark.conf.unset(automatic)
    assert re.search(r"PartitionFilters: \[[^\]]*ds", text) and "SelectedBucketsCount: 1 out of 4" in text
    assert found.count() == readings.filter((F.col("sn") == sn) & (F.to_date("createtime") == day)).count() > 0


def test_daily_aggregates_without_a_shuffle_of_readings(spark, table, readings):
    profile = layout.profile(spark, table)
    assert "Exchange" not in plan_text(profile)
    devices = profile.filter("size(reasons) = 0").select("sn", "last_seen")
    days, windows = layout.daily_aggregates(spark, table, devices, visible_date=dt.date(2024, 1, 20))
    text = plan_text(days)
    assert re.search(r"PartitionFilters: \[[^\]]*ds", text)
    assert "Exchange hashpartitioning" not in text
    clean, _, _ = plan.windowed_rows(readings, 0, 7, dt.date(2024, 1, 20))
    want = {(r["sn"], r["date"]): [v if not isinstance(v, float) else round(v, 8) for v in r[2:]] for r in d.daily_aggregates(clean).collect()}
    got = {(r["sn"], r["date"]): [v if not isinstance(v, float) else round(v, 8) for v in r[2:]] for r in days.collect()}
    assert got == want and windows.count() > 0
