"""Fleet scoring for a given day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..models import boosting, scoring, storage
from ..operators import daily as d
from ..operators import reshape
from ..sources.readers import read_columns
from .daily import matrix_columns, matrix_from_days, safe_name, window_days


def score_features(
    df: DataFrame, visible_date: dt.date | None, time_range: int = 7,
    spec: d.DailySpec = d.EVERYTHING, features: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features with the model code, cut-offs (sn, time), dropped devices)."""
    days, windows, dropped = window_days(df, 0, time_range, visible_date, spec)
    wanted = [
        c for c in matrix_columns(time_range, spec.thresholds)
        if features is None or safe_name(c[0]) in features
    ]
    matrix = matrix_from_days(days, wanted).withColumn("inverter_type_list", fn.device_type_code())
    return matrix, windows.select("sn", F.col("last_date").alias("time")), dropped


def score_fleet(
    df: DataFrame, model: PipelineModel | boosting.TreeModel | boosting.StoredTrees, features: Sequence[str], visible_date: dt.date | None,
    time_range: int = 7, spec: d.DailySpec = d.EVERYTHING, label: Column | None = None, classes: int = 3,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores, cut-offs, dropped devices); production thresholds unless ``label`` is given."""
    matrix, cutoffs, dropped = score_features(df, visible_date, time_range, spec, features)
    proba = scoring.predict_proba(model, matrix, features, classes)
    chosen = label if label is not None else scoring.multi_threshold_label(0.80, 0.80)
    return scoring.labelled_scores(proba, chosen), cutoffs, dropped


def score_latest(
    spark: SparkSession, df: DataFrame, root: str, visible_date: dt.date, time_range: int = 7, thresholds: tuple[float, float] = (0.80, 0.80),
) -> tuple[list[DataFrame], DataFrame, DataFrame]:
    """Scores by the newest saved model: ([label 0, label 1, label 2], cut-offs, dropped)."""
    model, features, _ = storage.load_latest(spark, root)
    label = scoring.multi_threshold_label(*thresholds)
    scores, cutoffs, dropped = score_fleet(df, model, features, visible_date, time_range, label=label)
    return scoring.split_by_label(scores), cutoffs, dropped


def score_binary(
    df: DataFrame, model: PipelineModel | boosting.TreeModel | boosting.StoredTrees, features: Sequence[str], visible_date: dt.date | None,
    time_range: int = 7, spec: d.DailySpec = d.EVERYTHING, threshold: float = 0.5,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Binary form: label 1 from the threshold on."""
    return score_fleet(
        df, model, features, visible_date, time_range, spec, scoring.binary_label(threshold), 2
    )


def score_single_file(
    spark: SparkSession, path: str, columns: Sequence[str], time_range: int = 30,
    spec: d.DailySpec = d.EVERYTHING, features: Sequence[str] | None = None,
) -> DataFrame:
    """Feature matrix of one file with a 30-day window."""
    matrix, _, _ = score_features(read_columns(spark, path, columns), None, time_range, spec, features)
    return matrix


def aligned_stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Feature frames stacked in the column order of the first."""
    return reshape.union_missing_ok(*[f.select(*frames[0].columns) for f in frames])
