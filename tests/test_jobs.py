"""A training and a scoring run from configuration files."""

import datetime as dt
import json

from pyspark.sql import functions as F

from sunfleet.config import ScoreConfig, TrainConfig, load_config
from sunfleet.models import storage
from sunfleet.plans import jobs
from sunfleet.schema import CORE_COLUMNS
from sunfleet.sources.event_log import read_telemetry


def test_train_and_score_from_files(spark, tmp_path):
    t = read_telemetry(spark, "/root/testdata/sf0.001")
    devices = [r["sn"] for r in t.select("sn").distinct().orderBy("sn").collect()]
    faulty = devices[::3]
    t.filter(F.col("sn").isin(faulty)).write.parquet(str(tmp_path / "fault.parquet"))
    t.filter(~F.col("sn").isin(faulty)).write.parquet(str(tmp_path / "ok.parquet"))
    (tmp_path / "labels.csv").write_text("sn,error_type\n" + "".join(f"{sn},{1 + k % 2}\n" for k, sn in enumerate(faulty)))
    shared = {"model_root": str(tmp_path / "models"), "columns": list(CORE_COLUMNS)}
    (tmp_path / "train.json").write_text(json.dumps({
        **shared, "ok_path": str(tmp_path / "ok.parquet"), "fault_path": str(tmp_path / "fault.parquet"), "label_path": str(tmp_path / "labels.csv"),
        "test_size": 0.2, "fault_offsets": [0, 1], "rounds": 2,
    }))
    (tmp_path / "score.json").write_text(json.dumps({**shared, "data_path": str(tmp_path / "ok.parquet"), "threshold_1": 0.2, "threshold_2": 0.9}))

    path, confusion = jobs.train_job(spark, TrainConfig.from_dict(load_config(str(tmp_path / "train.json"))), "2024_01_31")
    assert path.endswith("1_7/boosted_2024_01_31") and confusion.agg(F.sum("count")).first()[0] > 0
    assert storage.registry(spark, shared["model_root"]).count() == 1
    tables, cutoffs, dropped = jobs.score_job(spark, ScoreConfig.from_dict(load_config(str(tmp_path / "score.json"))), dt.date(2024, 1, 28))
    scored = [r for table in tables for r in table.collect()]
    assert len(scored) == cutoffs.count() and len(scored) + dropped.count() == t.filter(~F.col("sn").isin(faulty) & F.col("sn").startswith("TP")).select("sn").distinct().count()
    assert all(r["label"] == (2 if r["proba_label_2"] >= 0.9 else 1 if r["proba_label_1"] >= 0.2 else 0) for r in scored)
