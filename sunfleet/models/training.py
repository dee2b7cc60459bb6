"""Tree ensembles for failure prediction: boosted trees of our own (``boosting``), Spark ML ensembles as options."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import fill_scores_zero
from ..operators.sampling import stratified_kfold
from ..session import written
from . import boosting, evaluation


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def forest(seed: int = 42, trees: int = 60, depth: int = 5) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", maxDepth=depth, numTrees=trees,
        minInstancesPerNode=5, subsamplingRate=0.9, featureSubsetStrategy="0.6", seed=seed,
    )


def boosted(seed: int = 42, rounds: int = 20, depth: int = 5, step: float = 0.1) -> GBTClassifier:
    return GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", maxDepth=depth, maxIter=rounds,
        stepSize=step, minInstancesPerNode=3, subsamplingRate=0.8, seed=seed,
    )


def train_multiclass(
    train: DataFrame, features: Sequence[str], classifier=None, seed: int = 42, rounds: int = boosting.MULTICLASS.rounds,
    params: boosting.Params = boosting.MULTICLASS,
) -> PipelineModel | boosting.TreeModel:
    """Class-balanced boosted trees with a softmax loss; or the given Spark ML estimator, for any number of classes."""
    if classifier is None:
        return boosting.fit(train, features, replace(params, seed=seed, rounds=rounds))
    weighted = evaluation.class_weights(fill_scores_zero(train, features))
    return Pipeline(stages=[assembler(features), classifier]).fit(weighted)


def boosted_one_vs_rest(seed: int = 42, rounds: int = 20) -> OneVsRest:
    """Boosted trees for several classes: one binary model per class."""
    return OneVsRest(
        classifier=boosted(seed, rounds), labelCol="label", featuresCol="features", weightCol="weight"
    )


def train_binary(
    train: DataFrame, features: Sequence[str], positive_weight: float = 0.3, seed: int = 42, rounds: int = boosting.BINARY.rounds,
    params: boosting.Params = boosting.BINARY,
) -> boosting.TreeModel:
    """Boosted trees for label 0/1 with a fixed weight of the positive class."""
    return boosting.fit(train, features, replace(params, positive_weight=positive_weight, seed=seed, rounds=rounds))


MODELS = {"forest": forest, "boosted_one_vs_rest": boosted_one_vs_rest}
BOOSTED = "boosted"


def evaluate_model(
    name: str, train: DataFrame, test: DataFrame, features: Sequence[str], seed: int = 42, rounds: int = boosting.MULTICLASS.rounds
) -> tuple[PipelineModel | boosting.TreeModel, DataFrame]:
    """(model, predictions for the test rows) of the named ensemble."""
    if name != BOOSTED and name not in MODELS:
        raise ValueError(f"unsupported model name: {name}")
    model = train_multiclass(train, features, None if name == BOOSTED else MODELS[name](seed=seed), seed, rounds)
    if isinstance(model, boosting.TreeModel):
        return model, model.transform(test, [c for c in test.columns if c not in set(features)])
    return model, model.transform(fill_scores_zero(test, features))


def cross_validate(
    df: DataFrame, features: Sequence[str], identity: Sequence[str], folds: int = 5, seed: int = 42, params: boosting.Params = boosting.BINARY
) -> DataFrame:
    """Metrics per fold of boosted trees; the models of all folds grow together, on one read of the rows per level."""
    numbered = stratified_kfold(df, "label", identity, folds, seed)
    found = written(boosting.fold_predictions(numbered, features, folds, replace(params, seed=seed), identity), "fold-predictions")
    return fold_metrics(found, folds)


def fold_metrics(predicted: DataFrame, folds: int) -> DataFrame:
    """Metrics per fold of (fold, label, prediction)."""
    results = []
    for fold in range(folds):
        metrics = evaluation.classification_metrics(predicted.filter(F.col("fold") == fold).select("label", "prediction"))
        results.append(metrics.withColumn("fold", F.lit(fold)))
    return reduce(DataFrame.unionByName, results)


def cross_validate_each(
    df: DataFrame, features: Sequence[str], identity: Sequence[str], fit, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Metrics per fold for any ``fit(train) -> model``: one distributed fit after the other."""
    numbered = stratified_kfold(df, "label", identity, folds, seed)
    parts = []
    for fold in range(folds):
        model = fit(numbered.filter(F.col("fold") != fold))
        scored = model.transform(fill_scores_zero(numbered.filter(F.col("fold") == fold), features))
        parts.append(scored.select("fold", "label", "prediction"))
    return fold_metrics(reduce(DataFrame.unionByName, parts), folds)


def mean_metrics(per_fold: DataFrame) -> DataFrame:
    names = ["accuracy", "weighted_recall", "weighted_f1"]
    return per_fold.agg(*[F.avg(m).alias(m) for m in names])
