"""Whole jobs from configuration objects: every path, column list, window and threshold of a run comes from there."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import ScoreConfig, TrainConfig
from ..sources.readers import read_columns, read_file, read_folder
from . import scoring, training

LABELS = T.StructType([T.StructField("sn", T.StringType()), T.StructField("error_type", T.IntegerType())])


def train_job(spark: SparkSession, config: TrainConfig, stamp: str) -> tuple[str, DataFrame]:
    """Read, build the training matrix, fit and save: (path of the version, confusion matrix of the test rows)."""
    ok, fault = (read_columns(spark, path, config.columns) for path in (config.ok_path, config.fault_path))
    labels = read_file(spark, config.label_path, LABELS).select("sn", "error_type")
    matrix = training.training_matrix(
        ok, fault, labels, config.test_size, config.seed, config.time_range, tuple(config.fault_offsets),
        ok_label=config.ok_label, ok_out_days=config.ok_out_days,
    )
    return training.train(
        spark, matrix, config.model_root, stamp, out_days=max(config.fault_offsets), time_range=config.time_range, seed=config.seed, rounds=config.rounds
    )


def score_job(spark: SparkSession, config: ScoreConfig, visible_date: dt.date) -> tuple[list[DataFrame], DataFrame, DataFrame]:
    """Score a folder of readings by the newest model: ([label 0, label 1, label 2], cut-offs, dropped devices)."""
    rows = read_folder(spark, config.data_path, config.columns)
    return scoring.score_latest(
        spark, rows, config.model_root, visible_date, config.time_range, (config.threshold_1, config.threshold_2)
    )
