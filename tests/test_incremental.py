"""The stored daily state against one full run, for splits with late and repeated readings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sunfleet.plans import daily, incremental
from sunfleet.sources.event_log import read_telemetry
from sunfleet.streaming import extract


@pytest.fixture(scope="module")
def readings(spark):
    path = "/root/testdata/sf0.001"
    rows = read_telemetry(spark, path)
    # readings at midnight lie outside the oldest day of a window
    return rows.withColumn("createtime", F.when(F.crc32(F.col("etotal").cast("string")) % 9 == 0, F.date_trunc("day", "createtime")).otherwise(F.col("createtime"))).cache()


def matrix(df):
    return {r["sn"]: [None if v is None else round(v, 8) for v in r[1:]] for r in df.collect()}


@pytest.fixture(scope="module")
def expected(readings):
    return matrix(daily.daily_features(readings))


@pytest.mark.parametrize("seed", [3])
def test_any_split_equals_the_full_run(spark, tmp_path, readings, expected, seed):
    r = random.Random(seed)
    root, parts = str(tmp_path / "state"), r.randint(2, 3)
    batches = [(f"b{k}", F.pmod(F.xxhash64("sn", "etotal", F.lit(seed)), F.lit(parts)) == k) for k in range(parts)]
    r.shuffle(batches)
    late = r.choice(batches)
    for name, rule in [*batches, late, ("copies", F.col("etotal") % 5 == 0)]:
        incremental.absorb(spark, root, readings.filter(rule), name)
    assert matrix(incremental.features(spark, root)) == expected


def test_only_touched_days_are_read_and_written(spark, tmp_path, readings, expected):
    root = str(tmp_path / "state")
    day = dt.date(2024, 1, 20)
    incremental.absorb(spark, root, readings.filter(F.to_date("createtime") != day), "first")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "state" / "daily").rglob("*.parquet")}
    assert incremental.absorb(spark, root, readings.filter(F.to_date("createtime") == day), "second") == [day]
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "state" / "daily").rglob("*.parquet")}
    changed = {p.parent.name for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed == {f"ds={day}"}
    assert matrix(incremental.features(spark, root)) == expected
    for read in (incremental.stored_readings(spark, root, [day]), incremental.stored_days(spark, root, day, day)):
        assert "PartitionFilters: [isnotnull(ds" in read._jdf.queryExecution().toString() or "PartitionFilters: [ds" in read._jdf.queryExecution().toString()
        assert {p.rsplit("/", 2)[1] for p in [r[0] for r in read.select(F.input_file_name()).distinct().collect()]} == {f"ds={day}"}


def test_batches_without_readings(spark, tmp_path, readings):
    root = str(tmp_path / "state")
    assert incremental.absorb(spark, root, readings.filter("sn like 'TP%'"), "all") != []
    want = matrix(incremental.features(spark, root))
    assert incremental.absorb(spark, root, readings.filter("false"), "none") == []
    assert matrix(incremental.features(spark, root)) == want


def test_stream_of_files(spark, tmp_path, readings, expected):
    folder, root, progress = (str(tmp_path / n) for n in ("in", "state", "progress"))
    for k in range(2):
        readings.filter(F.pmod(F.xxhash64("etotal"), F.lit(2)) == k).coalesce(1).write.mode("append").parquet(folder)
        extract.keep_daily_state(extract.new_rows(spark, folder, readings.schema), root, progress)
    assert matrix(incremental.features(spark, root)) == expected
