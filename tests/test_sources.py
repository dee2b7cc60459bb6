"""Readers, writers and configuration."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sunfleet.config import ScoreConfig, TrainConfig, load_config
from sunfleet.schema import CONFIGURED_COLUMNS, CORE_COLUMNS, RAW_SCHEMA
from sunfleet.sources import readers, writers
from sunfleet.plans import fleet as fleet_plan
from validation import inputs


def test_reader_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "sn string, v double")
    df.write.parquet(str(tmp_path / "x.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "x.csv"))
    for name in ("x.parquet", "x.csv"):
        back = readers.read_file(spark, str(tmp_path / name), df.schema)
        assert sorted(map(tuple, back.collect())) == [("a", 1.5), ("b", None)]
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_file(spark, "x.xlsx")
    with pytest.raises(ValueError, match="missing"):
        readers.read_columns(spark, str(tmp_path / "x.parquet"), ["sn", "missing"])


def test_projection_reaches_the_scan(spark, sf_dir):
    plan = readers.read_columns(spark, f"{sf_dir}/events.parquet", ["event_id"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_files_by_name(spark, tmp_path):
    for day in (20240105, 20240120, 20240131):
        spark.range(day % 100).coalesce(1).write.parquet(str(tmp_path / "raw" / str(day)))
    for day in (20240105, 20240120, 20240131):
        part = next((tmp_path / "raw" / str(day)).glob("part-*.parquet"))
        target = tmp_path / "named" / ("deep" if day == 20240120 else ".").strip(".")
        target.mkdir(parents=True, exist_ok=True)
        (target / f"telemetry_{day}.parquet").write_bytes(part.read_bytes())
    found = readers.files_by_date_range(spark, str(tmp_path / "named"), "20240106", "20240131")
    assert found.count() == 20 + 31


@pytest.mark.parametrize(
    "run, expected",
    [((2024, 1, 1), ("20231130", "20231231")), ((2024, 4, 1), ("20240229", "20240331")), ((2024, 2, 15), ("20240114", "20240214"))],
)
def test_trailing_month(run, expected):
    assert readers.trailing_month_range(dt.date(*run)) == expected


def test_warehouse_predicates():
    parts = readers.daily_predicates("20240130", "20240201")
    assert len(parts) == 3
    assert parts[0] == "ds >= DATE '2024-01-30' AND ds < DATE '2024-01-31' AND sn LIKE 'TP%'"


def test_day_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, ds string")
    writers.write_days(df, path)
    writers.write_days(spark.createDataFrame([(9, "2024-01-02")], "v int, ds string"), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 9]


def test_overwrite_stays_below_the_root(spark, tmp_path):
    df = spark.range(3)
    root = str(tmp_path / "root")
    with pytest.raises(ValueError):
        writers.overwrite_output(df, root, str(tmp_path / "elsewhere"))
    with pytest.raises(ValueError):
        writers.overwrite_output(df, root, root)
    writers.overwrite_output(df, root, f"{root}/out")
    writers.overwrite_output(spark.range(2), root, f"{root}/out")
    assert spark.read.parquet(f"{root}/out").count() == 2


def test_batches_are_sorted_and_complete(spark, sf_dir, tmp_path):
    t = inputs.telemetry(spark, sf_dir).select("sn", "createtime", "etotal")
    writers.write_batches(t, str(tmp_path / "b"), 4)
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == t.count()
    per_batch = back.groupBy("batch_id").agg(F.countDistinct("sn").alias("n")).orderBy("batch_id").collect()
    devices = t.select("sn").distinct().count()
    assert [r["n"] for r in per_batch] == [4] * (devices // 4) + ([devices % 4] if devices % 4 else [])


def test_write_fleet(spark, sf_dir, tmp_path):
    t = inputs.telemetry(spark, sf_dir)
    t.coalesce(1).write.parquet(str(tmp_path / "raw"))
    source = next((tmp_path / "raw").glob("part-*.parquet"))
    (tmp_path / "dated").mkdir()
    (tmp_path / "dated" / "readings_20240120.parquet").write_bytes(source.read_bytes())
    out = fleet_plan.write_fleet(spark, str(tmp_path / "dated"), str(tmp_path / "out"), dt.date(2024, 2, 15), 5)
    assert spark.read.parquet(out).count() == inputs.clean(spark, sf_dir).count()


def test_manifest(spark, tmp_path):
    columns = ["b", "a.1", "c"]
    writers.write_manifest(spark, columns, str(tmp_path / "m"))
    assert readers.read_manifest(spark, str(tmp_path / "m")) == columns
    df = spark.createDataFrame([(1, 2, 3)], "c int, `a.1` int, b int")
    assert readers.project_manifest(df, columns).columns == columns
    assert readers.project_manifest(df, None).columns == df.columns


def test_config(tmp_path):
    path = tmp_path / "train.json"
    path.write_text(json.dumps({"ok_path": "a", "fault_path": "b", "label_path": "c", "model_root": "d", "test_size": 0.2}))
    config = TrainConfig.from_dict(load_config(str(path)))
    assert config.test_size == 0.2 and config.fault_offsets == tuple(range(8)) and len(config.columns) == 82
    with pytest.raises(ValueError, match="unknown settings"):
        ScoreConfig.from_dict({"data_path": "a", "model_root": "b", "surprise": 1})


def test_schemas():
    assert len(CORE_COLUMNS) == 34 and len(set(CONFIGURED_COLUMNS)) == 82
    assert set(CONFIGURED_COLUMNS) <= set(RAW_SCHEMA.names)


def test_output_paths_of_other_stores():
    from sunfleet.sources.writers import _parts

    assert _parts("hdfs://nn/out/../x") == ("hdfs", "nn", "/x")
    assert _parts("file:///a/b/./c") == _parts("/a/b/c") == ("file", "", "/a/b/c")
    with pytest.raises(ValueError):
        writers.overwrite_output(None, "hdfs://nn/out", "hdfs://nn/out/../elsewhere")
    with pytest.raises(ValueError):
        writers.overwrite_output(None, "hdfs://nn/out", "s3a://nn/out/x")


def test_intermediates_of_a_run_can_be_removed(spark):
    import os

    from sunfleet import session

    before = session.written(spark.range(3), "kept")
    run = session.start_run(spark)
    inside = session.new_path(spark, "x")
    assert f"run-{run}" in inside
    assert session.written(spark.range(5), "gone").count() == 5
    folder = os.path.dirname(inside)
    assert os.listdir(folder)
    session.cleanup(spark, run)
    assert not os.path.exists(folder) and before.count() == 3
    assert "run-" not in session.new_path(spark, "x")
    for name in ("", "..", "a/b"):
        with pytest.raises(ValueError):
            session.cleanup(spark, name)
