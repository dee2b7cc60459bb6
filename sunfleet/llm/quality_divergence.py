"""Quality rules by distribution divergence.

Each document has two histograms: its characters by class and its words by common word. They are compared with
those of the document's language by Jensen-Shannon distance (base 2, 0 to 1). The reference of a language is the mean
of the normalised histograms of all its documents that pass the base rules and are long enough, so every document
weighs the same. A document too short for a histogram to mean anything is not judged by it.

Defined cases: null text is empty text: no words, base failed. With a null lang, or a lang without a reference of its own (fewer than
``min_documents`` long documents: a mean of less says nothing), the distances are null and the base rules decide. Rows are judged one by one:
repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunfleet.llm.frames import fresh, small
from sunfleet.llm.kernels import LOWER, SPACE, SpanHash, flat, lists, per_row, rows_of, shingles, slices, words
from sunfleet.session import written

#: Character classes: a-z, A-Z, digits, sentence marks, exclamation marks, symbols, beyond ASCII, white space, other.
SENTENCE_MARKS, SYMBOLS = b".,;:?'\"()-", b"#*$%&|<>"
CLASSES = 9

#: Common words of the languages (fixed values: frequent function words).
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "for", "with", "as", "on", "by", "it", "was", "are", "be", "this", "from",
    "die", "der", "und", "den", "das", "von", "mit", "zu", "ist", "im", "des", "dem", "nicht", "ein", "eine", "auf", "für",
    "de", "la", "le", "les", "et", "en", "que", "pour", "dans", "un", "une", "du", "par", "sur", "pas", "il",
    "el", "los", "se", "las", "por", "con", "una", "su", "para", "al", "y", "no",
)

MIN_WORDS, REPEAT_PERCENT = 50, 50
#: Guards: characters and words below which a histogram is not judged.
MIN_CHARS_CLASS, MIN_WORDS_COMMON = 200, 80
#: Largest distances of a document that is kept: of each histogram alone, and of both at once (tables and lists are odd in both).
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MAX_BOTH = 0.30, 0.55, (0.12, 0.24)
MIN_DOCUMENTS = 20

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<long>, common array<long>"


def class_table() -> np.ndarray:
    table = np.full(256, 8, dtype=np.int64)
    table[ord("a"): ord("z") + 1] = 0
    table[ord("A"): ord("Z") + 1] = 1
    table[ord("0"): ord("9") + 1] = 2
    table[list(SENTENCE_MARKS)] = 3
    table[ord("!")] = 4
    table[list(SYMBOLS)] = 5
    table[0xC0:] = 6
    table[0x80:0xC0] = 9  # continues a character
    table[SPACE] = 7
    return table


def features(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts per row; ``classes`` and ``common`` are matrices."""
    data, starts, ends = flat(column)
    n = len(starts)
    row = np.repeat(np.arange(n), ends - starts)
    classes = np.bincount(row * 10 + class_table()[data], minlength=10 * n).reshape(n, 10)[:, :9]
    start, end, owner = words(data, starts, ends)
    n_words = np.bincount(owner, minlength=n)
    exact = SpanHash(data)(start, end)
    lower = SpanHash(LOWER[data])(start, end)
    # common words, the rest in the last bin
    listed = "".join(COMMON_WORDS).encode()
    size = np.array([len(w.encode()) for w in COMMON_WORDS])
    stop = np.cumsum(size)
    known = SpanHash(np.frombuffer(listed, dtype=np.uint8))(stop - size, stop)
    by = np.argsort(known)
    at = np.minimum(np.searchsorted(known[by], lower), len(known) - 1)
    index = np.where(known[by][at] == lower, by[at], len(known))
    common = np.bincount(owner * (len(known) + 1) + index, minlength=n * (len(known) + 1)).reshape(n, -1)
    return {
        "n_words": n_words, "word_chars": classes.sum(axis=1) - classes[:, 7], "n_symbols": classes[:, 5],
        "n_dup_lines": _repeated_lines(data, starts, ends), "n_repeat_words": _repeated_words(exact, owner, n_words),
        "classes": classes, "common": common,
    }


def _repeated_lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    n = len(starts)
    breaks = np.flatnonzero(data == 10)
    owner = np.concatenate([rows_of(breaks, ends), np.arange(n)])
    end = np.concatenate([breaks, ends])
    by = np.lexsort((end, owner))
    owner, end = owner[by], end[by]
    first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, dtype=bool)
    start = np.where(first, starts[owner], np.r_[0, end[:-1] + 1]) if len(owner) else end
    solid = np.concatenate([[0], np.cumsum(~SPACE[data])])
    full = solid[end] > solid[start]
    owner, start, end = owner[full], start[full], end[full]
    value, size = SpanHash(data)(start, end), end - start
    by = np.lexsort((size, value, owner))
    again = np.zeros(len(by), dtype=bool)
    again[1:] = (owner[by][1:] == owner[by][:-1]) & (value[by][1:] == value[by][:-1]) & (size[by][1:] == size[by][:-1])
    return np.bincount(owner[by[again]], minlength=n)


def _repeated_words(word: np.ndarray, owner: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Words in three-word windows that occur at least twice in their row."""
    value, row, first = shingles(word, owner, 3)
    by = np.lexsort((value, row))
    value, row = value[by], row[by]
    same = np.zeros(len(by) + 1, dtype=bool)
    same[1:-1] = (value[1:] == value[:-1]) & (row[1:] == row[:-1])
    twice = first[by[same[1:] | same[:-1]]]
    covered = np.zeros(len(word), dtype=bool)
    for k in range(3):
        covered[twice + k] = True
    return np.bincount(owner[covered], minlength=len(n_words))


def add_features(text: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replace the text in column ``text`` (by position) by its features, which become the last columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, batch.schema.names[text]):
                found = features(piece.column(text))
                columns = [c for i, c in enumerate(piece.columns) if i != text]
                for values in found.values():
                    if values.ndim == 1:
                        columns.append(pa.array(values, type=pa.int64()))
                    else:
                        columns.append(lists(values.ravel(), np.full(len(values), values.shape[1]), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def document_features(docs: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    """The ``keep`` columns and the features of every row."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_column).alias("_text"))
    fields = [docs.schema[c] for c in keep]
    out = T.StructType([*fields, *T.StructType.fromDDL(FEATURES).fields])
    return rows.mapInArrow(add_features(len(keep)), out)


def base_failed(min_words: int = MIN_WORDS, percent: int = REPEAT_PERCENT) -> str:
    return f"(n_words < {min_words} or 100 * n_repeat_words > {percent} * n_words)"


def _shares(column: str) -> str:
    """A histogram as shares."""
    return f"transform({column}, x -> cast(x as double) / aggregate({column}, 0L, (s, x) -> s + x))"


def distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two arrays of shares: the square root of the divergence in bits."""
    part = "if(x > 0, x * log2(2 * x / (x + y)), 0D) + if(y > 0, y * log2(2 * y / (x + y)), 0D)"
    return f"sqrt(greatest(0D, aggregate(zip_with({p}, {q}, (x, y) -> {part}), 0D, (s, v) -> s + v) / 2))"


def references(measured: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Mean histograms of the languages that have at least ``min_documents`` long documents."""
    long_enough = measured.filter(
        f"not {base_failed()} and n_words >= {MIN_WORDS_COMMON} and word_chars >= {MIN_CHARS_CLASS} and lang is not null"
    ).selectExpr("lang", f"{_shares('classes')} as p", f"{_shares('common')} as q")
    n = CLASSES, len(COMMON_WORDS) + 1
    sums = [f"sum(p[{i}]) as p{i}" for i in range(n[0])] + [f"sum(q[{i}]) as q{i}" for i in range(n[1])]
    means = long_enough.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *[F.expr(s) for s in sums]).filter(f"n >= {min_documents}")
    p, q = (f"array({', '.join(f'{k}{i} / n' for i in range(m))})" for k, m in zip("pq", n))
    return written(means.selectExpr("lang", f"{p} as class_reference", f"{q} as word_reference"), "references")


def judged(
    measured: DataFrame, means: DataFrame, max_class: float = MAX_CLASS_DISTANCE, max_words: float = MAX_WORD_DISTANCE, max_both: tuple[float, float] = MAX_BOTH,
) -> DataFrame:
    """``measured`` (with lang) plus class_distance, word_distance, base_failed, kept.

    Where a language has no reference (or a document no language) the distances are null and the base rules decide.
    """
    names = {n: fresh(measured, n) for n in ("class_reference", "word_reference")}
    own = means.selectExpr("lang as of", f"class_reference as {names['class_reference']}", f"word_reference as {names['word_reference']}")
    side = F.broadcast(own) if small(own) else own
    rows = measured.join(side, measured["lang"] == side["of"], "left").drop("of")
    references_of = names["class_reference"], names["word_reference"]
    compared = rows.withColumns({
        "class_distance": F.expr(f"if(n_words > 0 and {references_of[0]} is not null, {distance(_shares('classes'), references_of[0])}, null)"),
        "word_distance": F.expr(f"if(n_words > 0 and {references_of[1]} is not null, {distance(_shares('common'), references_of[1])}, null)"),
        "base_failed": F.expr(base_failed()),
    }).drop(*names.values())
    by_class, by_words = f"word_chars >= {MIN_CHARS_CLASS}", f"n_words >= {MIN_WORDS_COMMON}"
    strange = " or ".join([
        f"({by_class} and coalesce(class_distance > {max_class}D, false))",
        f"({by_words} and coalesce(word_distance > {max_words}D, false))",
        f"({by_class} and {by_words} and coalesce(class_distance > {max_both[0]}D and word_distance > {max_both[1]}D, false))",
    ])
    return compared.withColumn("kept", F.expr(f"not base_failed and not ({strange})"))


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per row of ``docs``: doc_id, lang, counts, distances, base_failed and kept."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    measured = written(document_features(rows, ["doc_id", "lang"]), "quality")
    return judged(measured, references(measured, min_documents)).drop("classes", "common")


def kept(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The texts are read twice and never shuffled."""
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    means = references(document_features(packed, ["lang"]), min_documents)
    good = judged(document_features(packed, ["row", "lang"]), means).filter("kept")
    return good.select(*[F.col("row").getField(c).alias(c) for c in columns])
