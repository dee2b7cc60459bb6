"""Quality classification by co-training on two views of a document.

View one is the text (character classes, common words, repetition), view two the metadata (language, source, length). Each
view has a logistic classifier. In every round both score all documents; each names its most confident ones that have no
label yet, and these train the *other* view from the next round on. In the end the views are calibrated on labels kept aside and combined:
their log odds add up, less the log odds of the prior, as for independent views.

At most ``sample`` labelled documents train the classifiers (the first by hash of the id) and each view hands over at most ``grow``
documents per class and round; these are the bounds of the training set. All documents are scored, in every round.

Defined cases: null text is empty text; null language, source or length are values of their own. A null id is scored but never trains.
Several labels of a document: good if one says so. Repeated rows are scored one by one. Without labels of both kinds every score is the
share of good labels, smoothed towards one half.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunfleet.llm.quality_divergence import CLASSES, document_features
from sunfleet.session import written

SAMPLE, GROW, ROUNDS, CONFIDENT = 20_000, 1_000, 3, 0.98
BUCKETS = {"source": 64, "lang": 16}
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)"


def text_view() -> str:
    words = "greatest(n_words, 1L)"
    rates = [f"n_repeat_words / {words}", f"n_symbols / {words}", f"n_dup_lines / {words}", f"word_chars / {words} / 10", "ln(n_words + 1D)", "cast(n_words < 50 as double)"]
    chars = "greatest(aggregate(classes, 0L, (s, v) -> s + v), 1L)"
    rates += [f"classes[{i}] / {chars} * 4" for i in range(CLASSES)] + [f"ln(1D + 1000D * classes[{i}] / {chars})" for i in (1, 4, 5, 8)]
    rates.append(f"1 - element_at(common, -1) / {words}")
    return "array(" + ", ".join(f"cast({r} as double)" for r in rates) + ")"


def metadata_view() -> str:
    parts = []
    for column, n in BUCKETS.items():
        parts.append(f"transform(sequence(0, {n - 1}), i -> cast(pmod(xxhash64(coalesce({column}, '')), {n}) = i as double))")
    length = "ln(coalesce(n_chars, 0L) + 1D)"
    steps = ", ".join(f"cast(coalesce(n_chars, 0L) >= {2**k} as double)" for k in range(7, 17))
    return f"concat({', '.join(parts)}, array({length}, cast(n_chars is null as double)), array({steps}))"


def views(docs: DataFrame, id_column: str, text_column: str, lang_column: str, source_column: str, length_column: str) -> DataFrame:
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(lang_column).cast("string").alias("lang"), F.col(source_column).cast("string").alias("source"),
        F.greatest(F.col(length_column).cast("long"), F.lit(0)).alias("n_chars"), F.col(text_column).alias("text"),
    )
    measured = document_features(rows, ["doc_id", "lang", "source", "n_chars"])
    return measured.selectExpr("doc_id", f"{text_view()} as a", f"{metadata_view()} as b")


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    model = LogisticRegression(maxIter=30, regParam=0.001, featuresCol="features", labelCol="label", weightCol="weight")
    return model.fit(rows.withColumn("features", array_to_vector(view)))


def _score(rows: DataFrame, model: LogisticRegressionModel, view: str, name: str) -> DataFrame:
    """Log odds of the good class, as a column."""
    scored = model.transform(rows.withColumn("_x", array_to_vector(view)).withColumnRenamed("_x", "features"))
    return scored.withColumn(name, vector_to_array("rawPrediction")[1]).drop("features", "rawPrediction", "probability", "prediction")


def _calibrate(rows: DataFrame, name: str) -> tuple[float, float]:
    """Slope and offset that make the log odds ``name`` fit the labels."""
    one = rows.select("label", F.array(name).alias("v"), F.lit(1.0).alias("weight"))
    model = LogisticRegression(maxIter=30, regParam=0.0001, featuresCol="features", labelCol="label").fit(one.withColumn("features", array_to_vector("v")))
    return float(model.coefficients[0]), float(model.intercept)


def scores(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, grow: int = GROW, rounds: int = ROUNDS, confident: float = CONFIDENT, held_out: str = HELD_OUT,
    id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source", length_column: str = "n_chars", label_column: str = "quality",
) -> DataFrame:
    """doc_id, held_out, text_score, metadata_score, score, kept per row of ``docs``; score is the chance of good quality."""
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    known = known.filter(f"doc_id is not null and label is not null and not {held_out}").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).selectExpr("doc_id", "cast(label as double) as label"), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    yes, no = counts.get(1.0, 0), sum(n for t, n in counts.items() if t != 1.0)
    pool = written(views(docs, id_column, text_column, lang_column, source_column, length_column), "views")
    prior = (yes + 1) / (yes + no + 2)
    flat_scores = pool.selectExpr("doc_id", f"{held_out} as held_out", f"{prior!r}D as text_score", f"{prior!r}D as metadata_score", f"{prior!r}D as score", f"{prior!r}D >= 0.5 as kept")
    if not yes or not no:
        return flat_scores
    base = pool.join(F.broadcast(known), "doc_id").withColumn("fold", F.expr("pmod(xxhash64(doc_id, 9L), 4)"))
    base = written(base.dropDuplicates(["doc_id"]).coalesce(4), "train")
    if base.filter("fold <> 0").select("label").distinct().count() < 2:  # labels of documents that are not in the table
        return flat_scores
    train = {v: base.filter("fold <> 0").select("doc_id", "a", "b", "label", F.lit(1.0).alias("weight")) for v in "ab"}
    taken = known.select("doc_id")
    limit = f"ln({confident!r}D / (1 - {confident!r}D))"
    for _ in range(rounds):
        handed = []
        for view, other in (("a", "b"), ("b", "a")):
            scored = _score(pool.filter(f"doc_id is not null and not {held_out}").join(F.broadcast(taken), "doc_id", "left_anti"), _fit(train[view], view), view, "s")
            for sign, label in (("s", 1.0), ("-s", 0.0)):
                best = scored.filter(f"{sign} >= {limit}").orderBy(F.expr(f"{sign} desc"), F.xxhash64("doc_id"), "doc_id").limit(grow)
                handed.append(best.select(F.lit(other).alias("to"), "doc_id", "a", "b", F.lit(label).alias("label")))
        more = handed[0]
        for part in handed[1:]:
            more = more.unionByName(part)
        # a document that both views name with different labels is left out
        agreed = F.expr("min(label) over (partition by doc_id) = max(label) over (partition by doc_id)")
        more = written(more.withColumn("agreed", agreed).filter("agreed").drop("agreed").dropDuplicates(["to", "doc_id"]), "handed")
        for view in "ab":
            train[view] = train[view].unionByName(more.filter(F.col("to") == view).select("doc_id", "a", "b", "label", F.lit(0.5).alias("weight")))
        taken = written(taken.unionByName(more.select("doc_id")).distinct(), "taken")  # sample + 4 * grow * rounds rows at most
    final = {v: _fit(train[v], v) for v in "ab"}
    kept_aside = base.filter("fold = 0")
    if kept_aside.select("label").distinct().count() < 2:
        kept_aside = base
    kept_aside = written(_score(_score(kept_aside, final["a"], "a", "sa"), final["b"], "b", "sb").select("label", "sa", "sb"), "calibration")
    lines = {v: _calibrate(kept_aside, f"s{v}") for v in "ab"}
    out = _score(_score(pool, final["a"], "a", "sa"), final["b"], "b", "sb")
    odds = {v: f"({lines[v][0]!r}D * s{v} + {lines[v][1]!r}D)" for v in "ab"}
    chance = "1 / (1 + exp(-({0})))".format
    both = f"{odds['a']} + {odds['b']} - ln({prior!r}D / (1 - {prior!r}D))"
    return out.selectExpr("doc_id", f"{held_out} as held_out", f"{chance(odds['a'])} as text_score", f"{chance(odds['b'])} as metadata_score", f"{chance(both)} as score", f"{both} >= 0 as kept")
