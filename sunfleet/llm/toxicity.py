"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration.

1. *Lexicon.* Words and word beginnings (4 to 10 bytes) of the labelled documents are counted by document and label. Those that are
   clearly more frequent in toxic documents (by the lower end of the log odds ratio) make the lexicon, at most ``TERMS``.
   Words are read in lower case with common letter substitutes undone.
2. *Features.* Densities and strengths of lexicon terms, their distance to second-person words, capitals, punctuation,
   obfuscation, word and text length: one pass over all texts.
3. *Trees.* Boosted trees on four fifths of the labelled sample, isotonic calibration on the rest.

Labels, language, source and id are never inputs of a score. At most ``sample`` labelled documents are used (the first by
hash of the id); everything else covers all documents.

Defined cases: null and empty texts have all counts 0 and get the score of such a text. Several labels of a document: toxic if one says so; a
null label is none. Repeated rows are scored one by one. Without labels of both kinds every score is the share of toxic labels,
smoothed towards one half.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunfleet.llm.kernels import LOWER, SPACE, SpanHash, flat, lists, mix, rows_of, slices, words
from sunfleet.session import written

SAMPLE, TERMS = 20_000, 400
#: Bytes of the word beginnings that are counted; 0: whole words.
STEMS = (0, 4, 5, 6, 7, 8, 10)
#: Standard errors by which a term must be more frequent in toxic documents, and in how many it must be.
ERRORS, LEAST = 3.5, 4
NEAR = 5
SECOND_PERSON = (
    "you", "your", "you're", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "sie", "tu", "te", "toi", "ton",
    "ta", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros", "tus",
)
FEATURES = (
    "hits", "density", "kinds", "strongest", "strength", "strength_density", "near_you", "near_density", "you_density", "capitals", "shouted",
    "exclamations", "questions", "runs", "obfuscated", "stretched", "symbols", "log_words", "word_length",
)

#: Lower case, and letters for their common substitutes.
PLAIN = LOWER.copy()
for _from, _to in zip(b"013457@$", b"oieastas"):
    PLAIN[_from] = _to
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
ODD = np.zeros(256, dtype=bool)
ODD[list(b"0123456789@$*#!%&+")] = True


def terms(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(stem length, index of the word, hash of the stem)."""
    spans = SpanHash(PLAIN[data])
    for k in STEMS:
        index = np.flatnonzero(end - start > k) if k else np.arange(len(start))
        stop = start[index] + k if k else end[index]
        yield k, index, mix(spans(start[index], stop), 40 + k)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term and label of the rows (text, toxic), summed per slice."""
    for batch in batches:
        for piece in slices(batch, "text"):
            data, starts, ends = flat(piece.column("text"))
            toxic = piece.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            start, end, row = words(data, starts, ends)
            found = [(row[index], value) for _, index, value in terms(data, start, end)]
            owner, value = (np.concatenate(x) for x in zip(*found))
            by = np.lexsort((owner, value))
            owner, value = owner[by], value[by]
            new = np.ones(len(by), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
            owner, value = owner[new], value[new]
            value, at = np.unique(value, return_inverse=True)
            yes = np.bincount(at, weights=toxic[owner], minlength=len(value)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(yes), pa.array(np.bincount(at, minlength=len(value)))], names=["term", "yes", "n"])


def learn_lexicon(texts: DataFrame, yes: int, no: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and strengths of the terms that mark toxic documents."""
    counted = texts.select("text", "toxic").mapInArrow(count_terms, "term long, yes long, n long").groupBy("term").agg(F.sum("yes").alias("a"), F.sum("n").alias("n"))
    odds = f"ln((a + 0.5D) / ({yes} - a + 0.5D)) - ln((n - a + 0.5D) / ({no} - (n - a) + 0.5D))"
    error = f"sqrt(1 / (a + 0.5D) + 1 / ({yes} - a + 0.5D) + 1 / (n - a + 0.5D) + 1 / ({no} - (n - a) + 0.5D))"
    best = counted.filter(f"a >= {LEAST}").selectExpr("term", f"{odds} - {ERRORS} * {error} as strength").filter("strength > 0.5").orderBy(F.desc("strength"), "term").limit(TERMS).collect()
    best = sorted(((np.int64(r["term"]).view(np.uint64), r["strength"]) for r in best))
    return np.array([t for t, _ in best], dtype=np.uint64), np.array([s for _, s in best], dtype=np.float64)


def features(column: pa.Array, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Matrix of FEATURES, one row per text."""
    data, starts, ends = flat(column)
    n = len(starts)
    start, end, row = words(data, starts, ends)
    count = np.bincount(row, minlength=n)
    per_word = np.maximum(count, 1)
    size = np.maximum(ends - starts, 1)
    known, weight = lexicon
    strength = np.zeros(len(start))
    which = np.full(len(start), -1)
    if len(known):
        for _, index, value in terms(data, start, end):
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            hit = (known[at] == value) & (weight[at] > strength[index])
            strength[index[hit]] = weight[at[hit]]
            which[index[hit]] = at[hit]
    hit = np.flatnonzero(which >= 0)
    spans = SpanHash(LOWER[data])
    listed = [w.encode() for w in SECOND_PERSON]
    stop = np.cumsum([len(w) for w in listed])
    persons = np.sort(SpanHash(np.frombuffer(b"".join(listed), dtype=np.uint8))(stop - [len(w) for w in listed], stop))
    value = spans(start, end)
    you = np.flatnonzero(persons[np.minimum(np.searchsorted(persons, value), len(persons) - 1)] == value)
    near = np.zeros(len(hit), dtype=bool)
    if len(you) and len(hit):
        k = np.searchsorted(you, hit)
        for other in (np.maximum(k - 1, 0), np.minimum(k, len(you) - 1)):
            near |= (np.abs(you[other] - hit) <= NEAR) & (row[you[other]] == row[hit])
    kinds = np.unique(row[hit] * (len(known) + 1) + which[hit]) // (len(known) + 1) if len(hit) else np.zeros(0, dtype=np.int64)
    strongest = np.zeros(n)
    np.maximum.at(strongest, row[hit], strength[hit])
    upper = (data >= 65) & (data <= 90)
    letters = np.r_[0, np.cumsum(LETTER[data])]
    capital = np.r_[0, np.cumsum(upper)]
    odd = np.r_[0, np.cumsum(ODD[data])]
    of = rows_of(np.arange(len(data)), ends) if len(data) else np.zeros(0, dtype=np.int64)
    in_row = np.bincount(of[LETTER[data]], minlength=n)
    sums = lambda mask: np.bincount(of[mask], minlength=n)
    counts = lambda mask: np.bincount(row[mask], minlength=n)
    mark = (data == 33) | (data == 63)
    pair = np.zeros(len(data), dtype=bool)
    pair[1:] = mark[1:] & mark[:-1]
    same = np.zeros(len(data), dtype=bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & LETTER[data[2:]]
    # a substitute between letters: the word's first and last byte are letters and something odd lies within
    inner = (end - start > 2) & (odd[np.maximum(end - 1, start)] - odd[start] > 0) & LETTER[data[start]] & LETTER[data[end - 1]] if len(start) else np.zeros(0, dtype=bool)
    shouted = (capital[end] - capital[start] > 1) & (capital[end] - capital[start] == letters[end] - letters[start])
    total = np.bincount(row[hit], weights=strength[hit], minlength=n)
    columns = (
        counts(hit), counts(hit) / per_word, np.bincount(kinds, minlength=n), strongest, total, total / per_word, counts(hit[near]), counts(hit[near]) / per_word,
        counts(you) / per_word, sums(upper) / np.maximum(in_row, 1), counts(shouted) / per_word, sums(data == 33) / size, sums(data == 63) / size, sums(pair) / size,
        counts(inner) / per_word, sums(same) / size, sums(ODD[data]) / size, np.log1p(count), (size - sums(SPACE[data])) / per_word,
    )
    return np.column_stack([np.asarray(c, dtype=np.float64) for c in columns])


def add_features(lexicon: tuple[np.ndarray, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                matrix = features(piece.column("text"), lexicon)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists(matrix.ravel(), np.full(len(matrix), matrix.shape[1]), pa.float64())], names=["doc_id", "x"])

    return run


HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)"


def scores(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = 40, depth: int = 4, held_out: str = HELD_OUT,
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``; labels of rows with ``held_out`` are not learned from."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("toxic"))
    known = known.filter(f"doc_id is not null and toxic is not null and not {held_out}").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # proven bound: ``sample`` rows
    chosen = written(chosen, "labelled")
    counts = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    yes, no = counts.get(1, 0), sum(n for t, n in counts.items() if t != 1)
    prior = (yes + 1) / (yes + no + 2)
    flat_scores = rows.selectExpr("doc_id", f"{held_out} as held_out", f"{prior!r}D as score", f"cast({prior!r}D >= 0.5 as int) as predicted")
    if not yes or not no:
        return flat_scores
    lexicon = learn_lexicon(rows.join(F.broadcast(chosen), "doc_id"), yes, no)
    dense = written(rows.mapInArrow(add_features(lexicon), "doc_id long, x array<double>"), "features")
    train = dense.join(F.broadcast(chosen), "doc_id").selectExpr("x", "cast(toxic = 1 as double) as label", "pmod(xxhash64(doc_id, 3L), 5) as fold")
    train = written(train.coalesce(4), "train").withColumn("features", array_to_vector("x"))
    if train.filter("fold <> 0").select("label").distinct().count() < 2:  # labels of documents that are not in the table
        return flat_scores
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, seed=5, featuresCol="features", labelCol="label")
    fitted = trees.fit(train.filter("fold <> 0"))
    raw = F.try_element_at(vector_to_array("rawPrediction"), F.lit(2))
    rest = fitted.transform(train.filter("fold = 0")).select("label", raw.alias("raw"))
    rest = written(rest, "calibration")
    if rest.select("label").distinct().count() < 2:
        rest = fitted.transform(train).select("label", raw.alias("raw"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(rest)
    marked = fitted.transform(dense.withColumn("features", array_to_vector("x"))).select("doc_id", raw.alias("raw"))
    return curve.transform(marked).selectExpr("doc_id", f"{held_out} as held_out", "least(1D, greatest(0D, score)) as score").withColumn("predicted", F.expr("cast(score >= 0.5 as int)"))
