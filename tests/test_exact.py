"""Means that do not depend on the order of rows, and intervals that meet readings by month."""

import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sunfleet.operators import fleet, series


def exact_counts(values):
    mean = sum(map(Fraction, values)) / len(values)
    return sum(Fraction(v) > mean for v in values), sum(Fraction(v) < mean for v in values)


def cases():
    r = random.Random(4)
    tenths = [50 - k % 5 / 100 for k in range(48)]
    out = {
        "tenths": tenths, "constant": [0.1] * 37, "third": [0.1, 0.2, 0.3] * 11, "negative": [-x for x in tenths], "signs": [-0.7, 0.7, 0.0, -0.0] * 5,
        "spread": [r.uniform(-1, 1) * 10 ** r.randint(-6, 9) for _ in range(301)], "cancel": [1e11, 0.1, -1e11, 0.1, 0.1], "one": [3.3], "huge": [1e15, 1e15, 2e15, 3.0],
        "unit": [r.random() for _ in range(200)], "close": [1.0, 1.0 + 2**-52, 1.0 + 2**-51] * 3,
    }
    return out


@pytest.mark.parametrize("parts", [1, 4, 31])
def test_counts_around_the_exact_mean(spark, parts):
    start = dt.datetime(2024, 1, 1)
    rows = [(sn, start + dt.timedelta(minutes=17 * k), float(v), float(v)) for sn, values in cases().items() for k, v in enumerate(values)]
    rows += [("inf", start, float("inf"), 1.0), ("inf", start + dt.timedelta(hours=1), 1.0, 2.0), ("null", start, None, None)]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "sn string, createtime timestamp, x double, y double").repartition(parts)
    found = {(r["sn"], r["kind"]): (r["count_above_mean"], r["count_below_mean"]) for r in series.position_features(df, ["x", "y"], ["mean_counts"]).collect()}
    for sn, values in cases().items():
        assert found[sn, "x"] == found[sn, "y"] == exact_counts(values), sn
    assert found["inf", "x"] == (0, 1) and found["inf", "y"] == (1, 1) and found["null", "x"] == (0, 0)


def test_intervals_of_one_hot_device(spark):
    r = random.Random(9)
    base = dt.datetime(2023, 11, 20)
    rows = [("hot" if k % 3 == 0 else f"d{k % 40}", base + dt.timedelta(hours=r.randint(0, 4000)), k) for k in range(3000)]
    listed = [(sn, dt.date(2023, 12, 1) + dt.timedelta(days=r.randint(0, 120))) for sn in ["hot"] * 12 + [f"d{k}" for k in range(40)] * 2 + ["none"]]
    rows.append(("hot", dt.datetime.combine(listed[0][1], dt.time()), -1))  # both ends belong to an interval
    rows.append(("hot", dt.datetime.combine(listed[0][1] - dt.timedelta(days=45), dt.time()), -2))
    df = spark.createDataFrame(rows, "sn string, createtime timestamp, k int").repartition(6)
    wanted = spark.createDataFrame(listed, "sn string, return_date date")
    got = sorted((x["sn"], x["k"], x["return_date"]) for x in fleet.interval_fetch_all(df, wanted, 45).collect())
    want = sorted(
        (sn, k, day) for sn, at, k in rows for other, day in set(listed)
        if sn == other and dt.datetime.combine(day - dt.timedelta(days=45), dt.time()) <= at <= dt.datetime.combine(day, dt.time())
    )
    assert got == want
    text = wanted.withColumn("return_date", F.date_format("return_date", "yyyyMMdd"))
    assert fleet.interval_fetch_all(df, text, 45).count() == len(want)
