"""Devices whose readings fit into one task, and longer ones: the same statistics, without shuffling a row per reading and metric."""

import datetime as dt
import math

import pytest

from sunfleet.operators import series, special

KINDS, START = ["a", "b"], dt.datetime(2024, 1, 1)


@pytest.fixture()
def readings(spark):
    rows = []
    for device, n in (("x", 3), ("y", 17), ("z", 40)):
        for k in range(n):
            rows.append((device, START + dt.timedelta(minutes=40 * (k // 2)), float(k), float((k * 7) % 11) - 3, None if k % 5 == 2 else float(k % 3)))
    rows.append((None, START, 0.0, 5.0, 6.0))
    return spark.createDataFrame(rows, "sn string, createtime timestamp, tie double, a double, b double")


def values(df):
    close = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v
    return sorted([tuple(close(v) for v in row) for row in df.collect()], key=str)


@pytest.mark.parametrize("limit", [0, 17])
def test_short_and_long_devices_have_the_same_statistics(readings, limit):
    which = ["moments", *series.POSITION, *series.NEIGHBOUR]
    cut = lambda n: series.dealt(readings, KINDS, ["tie"], n)
    for call in (
        lambda rows: series.series_features(rows, KINDS, which, ["tie"]), lambda rows: series.series_features(rows, KINDS, which, ["tie"], True),
        lambda rows: series.moment_features(rows, KINDS), lambda rows: series.quantile_features(rows, KINDS),
        lambda rows: series.quantile_features(rows, KINDS, interpolation="nearest"), lambda rows: special.number_cwt_peaks(rows, KINDS, (1, 3), ["tie"]),
    ):
        assert values(call(cut(limit))) == values(call(cut(1000)))


def test_a_short_device_is_shuffled_as_wide_rows_only(spark, readings):
    rows = readings.filter("sn is not null")
    for found in (series.moment_features(rows, KINDS), series.quantile_features(rows, KINDS), series.neighbour_features(rows, KINDS, tie_breakers=["tie"])):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(sn" in plan and "kind" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)
