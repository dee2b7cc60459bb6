"""Language of a text: averaged hashed subword embeddings and a linear softmax, trained by stochastic gradient descent in numpy.

A text is lower-cased (A to Z) and split at everything that is not a letter or beyond ASCII; its subwords are the strings of 2 to 4 bytes
inside words, word borders included, hashed to ``BUCKETS`` numbers. The mean of their embeddings goes through a linear layer and a softmax.
Training rows see random stretches of their subwords, so that short texts are met as well. The probabilities are calibrated: one temperature,
fitted on rows left out of training. A text is *rejected* where its probability lies below the smallest bound that keeps ``PRECISION`` on these rows.

The model is fitted on the driver on a bounded sample (``per_language`` rows of each language, ``rows`` in all, ``SUBWORDS`` subwords of each row, taken at even
steps over the whole text); prediction reads every whole text in the tasks, in pieces.

Null texts and texts without a letter are ``und`` with score 0 and rejected, also all texts if nothing could be learned. A row without an id is not held
out and teaches nothing. Repeated rows each get the same answer. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunfleet.llm.frames import bounded_batches, joined
from sunfleet.session import written

UNKNOWN = "und"
BUCKETS, DIMENSIONS, LENGTHS = 1 << 15, 16, (2, 3, 4)
#: Bounds of the training sample. Up to 1,000 rows of a group Spark picks before it shuffles, so a frequent language sends few.
PER_LANGUAGE, ROWS, SUBWORDS = 1000, 8000, 512
#: Training: steps, rows of a step, learning rates of embeddings and layer, smallest stretch of subwords, seed; precision the rejection bound keeps.
STEPS, STEP, RATE, LAYER_RATE, SHORTEST, SEED, PRECISION = 1000, 64, 50.0, 2.0, 6, 11, 0.995
#: Bytes of a text that are hashed at once.
PIECE = 1 << 18

WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LETTER = re.compile(b"[A-Za-z]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text: bytes) -> bool:
    return bool(LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))


def pieces(text: bytes) -> Iterator[bytes]:
    """Words between single spaces, cut between words into pieces of about ``PIECE`` bytes."""
    plain, start = text.translate(WORDS), 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        words = b" ".join(plain[start:end].split())
        if words:
            yield b" " + words + b" "
        start = end


def subwords(piece: bytes, starts: int | None = None) -> np.ndarray:
    """Buckets of all strings of the wanted lengths that have a space at most at either end and begin in the first ``starts`` bytes, by length and place."""
    data = np.frombuffer(piece, np.uint8)
    code, blank = data.astype(np.uint64), data == 32
    found, rolled = [], code
    inner = np.zeros(len(data), bool)
    for length in range(2, max(LENGTHS) + 1):
        if length > len(data):
            break
        rolled = rolled[:-1] * np.uint64(1_000_003) + code[length - 1:]
        inner = inner[:-1] | blank[length - 2:-1] if length > 2 else np.zeros(len(data) - 1, bool)
        if length in LENGTHS:
            mixed = (rolled[:starts][~inner[:starts]] + np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    bound: float = 0.0

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        logits = (mean @ self.weights + self.bias) / self.temperature
        powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
        return powers / powers.sum(axis=-1, keepdims=True)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        total, n = np.zeros(DIMENSIONS), 0
        for piece in pieces(text):
            # one part, but for a word longer than a piece
            for start in range(0, len(piece), 4 * PIECE):
                counts = np.bincount(subwords(piece[start:start + 4 * PIECE + max(LENGTHS) - 1], 4 * PIECE), minlength=BUCKETS)
                used = np.flatnonzero(counts)
                total += counts[used].astype(np.float32) @ self.embeddings[used]
                n += int(counts[used].sum())
        chances = self.probabilities(total / max(n, 1))
        best = int(chances.argmax())
        score = min(1.0, float(chances[best]))
        return self.languages[best], score, score < self.bound


def _frequencies(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for k, row in enumerate(rows):
        used, n = np.unique(row, return_counts=True)
        out[k, used] = n / max(len(row), 1)
    return out


def train(rows: list[np.ndarray], labels: list[str], seed: int = SEED) -> Model:
    """Fit on the subwords of labelled rows; every fifth row only calibrates (all rows do if there are fewer than five)."""
    languages = sorted(set(labels))
    draw = np.random.default_rng(seed)
    model = Model(
        languages, draw.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32),
        np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32),
    )
    if not rows:
        return model
    number = {lang: k for k, lang in enumerate(languages)}
    wanted = np.array([number[lang] for lang in labels])
    learn = np.array([k for k in range(len(rows)) if k % 5 != 4])
    check = np.array([k for k in range(len(rows)) if k % 5 == 4]) if len(rows) >= 5 else learn
    balance = 1 / np.bincount(wanted[learn], minlength=len(languages)).clip(1)
    balance = (balance * len(learn) / max(1, np.count_nonzero(np.bincount(wanted[learn], minlength=len(languages))))).astype(np.float32)
    order = np.zeros(0, np.int64)
    for done in range(STEPS):
        if len(order) < STEP:
            order = np.concatenate([order, draw.permutation(learn)])
        batch, order = order[:STEP], order[STEP:]
        x = _frequencies([_stretch(rows[k], draw) for k in batch])
        used = np.flatnonzero(x.any(axis=0))
        x = x[:, used]
        mean = x @ model.embeddings[used]
        error = model.probabilities(mean).astype(np.float32)
        error[np.arange(len(batch)), wanted[batch]] -= 1
        error *= balance[wanted[batch], None] / len(batch)
        rate, slope = np.float32(1 - done / STEPS), error @ model.weights.T
        model.weights -= rate * np.float32(LAYER_RATE) * (mean.T @ error)
        model.bias -= rate * np.float32(LAYER_RATE / 100) * error.sum(axis=0)
        # an embedding meets few rows of a step, and a small part of each
        model.embeddings[used] -= rate * np.float32(RATE) * (x.T @ slope)
    calibrate(model, [rows[k] for k in check], wanted[check])
    return model


def _stretch(row: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """A run of subwords; its length is spread evenly over the orders of magnitude."""
    if len(row) <= SHORTEST:
        return row
    length = int(np.exp(draw.uniform(np.log(SHORTEST), np.log(len(row)))))
    start = int(draw.integers(0, len(row) - length + 1))
    return row[start:start + length]


def calibrate(model: Model, rows: list[np.ndarray], wanted: np.ndarray) -> None:
    """Temperature of least loss, and the smallest probability at and above which ``PRECISION`` of the rows are right; short stretches count too.

    Where no row is wrong, the least loss would be at temperature 0; so the truth counts as certain only up to one row in all rows and two.
    """
    stretches = [r[:n] for n in (24, 96, SUBWORDS) for r in rows]
    truth = np.tile(wanted, 3)
    mean = np.concatenate([_frequencies(stretches[k:k + 256]) @ model.embeddings for k in range(0, len(stretches), 256)])
    best, doubt = (np.inf, 1.0), 1 / (len(truth) + 2)
    for temperature in np.geomspace(0.05, 20, 81):
        model.temperature = float(temperature)
        losses = -np.log(model.probabilities(mean).clip(1e-30))
        right = losses[np.arange(len(truth)), truth]
        others = (losses.sum(axis=1) - right) / max(1, len(model.languages) - 1)
        best = min(best, (float(((1 - doubt) * right + doubt * others).mean()), model.temperature))
    model.temperature = best[1]
    chances = model.probabilities(mean)
    order = np.argsort(-chances.max(axis=1), kind="stable")
    right = (chances.argmax(axis=1) == truth)[order]
    share = np.cumsum(right) / np.arange(1, len(right) + 1)
    good = np.flatnonzero(share >= PRECISION)
    model.bound = min(PRECISION, float(chances.max(axis=1)[order][good[-1]])) if len(good) else PRECISION


def _row_subwords(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, order and subwords of training rows, in the order of the text; of long texts at even steps."""
    kind = pa.list_(pa.int32())
    for batch in batches:
        found = []
        for text in batch.column(2):
            # by place and not by length, so that a stretch of them is a stretch of the text
            parts = [_by_place(p) for p in pieces(text.as_py())] if has_letter(text.as_py()) else []
            row = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            found.append(row[np.linspace(0, len(row) - 1, SUBWORDS).astype(np.int64)] if len(row) > SUBWORDS else row)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], ["lang", "place", "subwords"])


def _by_place(piece: bytes) -> np.ndarray:
    """The subwords of a piece, word by word."""
    words = piece.split()
    if len(words) <= 1:
        return subwords(piece)
    # whole runs of words: the order inside a run does not matter to a mean
    return np.concatenate([subwords(b" " + b" ".join(words[k:k + 4]) + b" ") for k in range(0, len(words), 4)])


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, rows: int = ROWS) -> tuple[list[np.ndarray], list[str]]:
    """Subwords and languages of a bounded sample of rows that may teach, by the hash of their id; languages take turns."""
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED))
    taught = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    taught = taught.select(F.col("lang").cast("string").alias("lang"), key.alias("key"), F.col("text").cast("binary").alias("text"))
    turns = Window.partitionBy("lang").orderBy("key")
    chosen = taught.select("lang", "key").withColumn("place", F.row_number().over(turns)).filter(F.col("place") <= per_language)
    chosen = written(chosen.groupBy("lang", "key").agg(F.min("place").alias("place")), "language-sample")
    read = joined(taught, chosen, ["lang", "key"]).select("lang", "place", "text").mapInArrow(_row_subwords, "lang string, place int, subwords array<int>")
    found = read.filter(F.size("subwords") > 0).orderBy("place", "lang", "subwords").limit(rows).collect()
    return [np.array(r["subwords"], np.int64) for r in found], [r["lang"] for r in found]


def predictions(docs: DataFrame, per_language: int = PER_LANGUAGE, rows: int = ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(*sample(docs, per_language, rows)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.predict(text.as_py()) for text in batch.column(2)]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    given = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    kind = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])
    return given.mapInArrow(predict, kind)
