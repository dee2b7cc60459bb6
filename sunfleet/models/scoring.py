"""Probabilities, labels and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import fill_scores_zero
from . import boosting


def predict_proba(
    model: PipelineModel | boosting.TreeModel | boosting.StoredTrees, df: DataFrame, features: Sequence[str], classes: int = 3, ids: Sequence[str] = ("sn",)
) -> DataFrame:
    """(ids, proba_label_0 ...); features are taken by manifest, so their order is the model's."""
    if isinstance(model, PipelineModel):
        scored, proba = model.transform(fill_scores_zero(df.select(*ids, *features), features)), vector_to_array("probability")
    else:
        scored, proba = model.transform(df, ids), F.col("probability")
    return scored.select(*ids, *[proba[i].alias(f"proba_label_{i}") for i in range(classes)])


def multi_threshold_label(threshold_1: float = 0.7, threshold_2: float = 0.7) -> Column:
    """Class 2 before class 1 before 0; the class-0 probability takes no part."""
    return (
        F.when(F.col("proba_label_2") >= F.lit(threshold_2), 2)
        .when(F.col("proba_label_1") >= F.lit(threshold_1), 1)
        .otherwise(0)
    )


def binary_label(threshold: float = 0.5) -> Column:
    return F.when(F.col("proba_label_1") >= F.lit(threshold), 1).otherwise(0)


def labelled_scores(proba: DataFrame, label: Column) -> DataFrame:
    probabilities = [c for c in proba.columns if c.startswith("proba_label_")]
    return proba.select("sn", label.alias("label"), *probabilities)


def split_by_label(scores: DataFrame, classes: Sequence[int] = (0, 1, 2)) -> list[DataFrame]:
    return [scores.filter(F.col("label") == c) for c in classes]


def all_flagged_check(scores: DataFrame) -> DataFrame:
    """One row: is every device flagged? Then thresholds or model deserve a look."""
    return scores.agg(F.bool_and(F.col("label") != 0).alias("all_flagged"))
