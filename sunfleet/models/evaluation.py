"""Class weights, metrics and importances as aggregates; nothing but totals leaves the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Balanced weights ``n / (k * n_label)``, joined from the class counts (one row per class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_k"))
    weights = counts.join(F.broadcast(totals)).select(  # totals: one row by construction
        label, (F.col("_total") / (F.col("_k") * F.col("_n")).cast("double")).alias(name)
    )
    return df.join(weights, label)


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(
    df: DataFrame, classes: Sequence[int], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Counts for every (actual, predicted) pair of the classes, 0 where none occurs."""
    names = F.array(*[F.lit(int(c)) for c in classes])
    grid = df.sparkSession.range(1).select(F.explode(names).alias("label")).select(
        "label", F.explode(names).alias("prediction")
    )
    counts = confusion_counts(df, label, prediction)
    return grid.join(counts, ["label", "prediction"], "left").fillna(0, ["count"])


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy, weighted recall and weighted F1, from the (label, prediction) counts."""
    counts = confusion_counts(df, label, prediction)
    same = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    actual = counts.groupBy(F.col("label").alias("class")).agg(
        F.sum("count").alias("support"), F.sum(same).alias("hits")
    )
    predicted = counts.groupBy(F.col("prediction").alias("class")).agg(
        F.sum("count").alias("predicted")
    )
    per_class = actual.join(predicted, "class", "left").fillna(0, ["predicted"])
    # 2PR / (P + R) = 2 hits / (support + predicted)
    f1 = 2.0 * F.col("hits") / (F.col("support") + F.col("predicted"))
    total = F.sum("support").cast("double")
    return per_class.agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum("hits") / total).alias("weighted_recall"),
        (F.sum(F.col("support") * f1) / total).alias("weighted_f1"),
    )


def split_counts(spark: SparkSession, forest_path: str, names: Sequence[str]) -> DataFrame:
    """(feature, score): how many tree nodes split on each feature, read from the saved forest."""
    nodes = spark.read.parquet(f"{forest_path}/data")
    position = F.col("nodeData.split.featureIndex")
    counts = nodes.filter(position >= 0).groupBy(position.alias("position")).agg(
        F.count(F.lit(1)).alias("score")
    )
    listed = spark.createDataFrame(list(enumerate(names)), "position int, feature string")
    return counts.join(listed, "position").select("feature", "score")


def tree_split_counts(trees: DataFrame) -> DataFrame:
    """(feature, score) of a table of boosted trees."""
    return trees.filter(F.col("feature").isNotNull()).groupBy("feature").agg(F.count(F.lit(1)).alias("score"))
