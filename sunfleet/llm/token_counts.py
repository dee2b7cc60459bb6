"""Token counts per section by offset mapping.

A document is encoded once, as a whole; the byte lengths of its tokens give their spans, and the spans are joined to the sections' intervals by
binary search. A token that crosses a border is allocated by rule:

* ``first``: to the section of its first byte;
* ``last``: to the section of its last byte;
* ``share``: to every section by its share of bytes.

Sections are (name, start, end) in bytes, sorted and apart; tokens outside all sections count as ``(none)``.

Defined cases: null and empty texts have no tokens and no sections. Whole texts are encoded, whatever their length; white space in runs that would
exhaust the tokenizer's pattern matcher is cut out the way the pattern cuts it and merged as the one piece it is. Repeated rows are counted one by one.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Splits a text into pieces before byte pairs are merged (fixed value of the published vocabulary).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OUTSIDE = "(none)"

#: White space of the pattern (fixed value: the Unicode property), in runs that are split off before matching.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{20001,}")


def read_ranks(spark, path: str) -> dict[bytes, int]:
    """Vocabulary of ``path`` (one file, lines of base64 token and rank), read by Spark."""
    content = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, bytes(content).splitlines()) if a}


def line_sections(text: bytes) -> list[tuple[str, int, int]]:
    """Sections of a document by its lines: ``title`` (the first line), ``table`` (rows of cells between bars), ``body``."""
    out: list[tuple[str, int, int]] = []
    at = 0
    while at < len(text):
        stop = text.find(b"\n", at) + 1 or len(text)
        name = "title" if at == 0 else "table" if text.count(b" | ", at, stop) >= 2 else "body"
        if out and out[-1][0] == name and name != "title":
            out[-1] = (name, out[-1][1], stop)
        else:
            out.append((name, at, stop))
        at = stop
    return out


def allocate(sizes: np.ndarray, sections: list[tuple[str, int, int]], rule: str) -> tuple[dict[str, float], int]:
    """Tokens per section name, and the number of tokens that cross a border."""
    end = np.cumsum(sizes)
    start = end - sizes
    edges = np.array([x for _, a, b in sections for x in (a, b)], dtype=np.int64)
    names = [n for n, _, _ in sections]
    # odd places of ``edges`` lie inside a section
    first = np.searchsorted(edges, start, side="right")
    last = np.searchsorted(edges, end - 1, side="right")
    crossing = int(np.count_nonzero(first != last))
    out: dict[str, float] = {}

    def give(place: np.ndarray, weight: np.ndarray | None = None) -> None:
        for k, n in enumerate(np.bincount(place, weights=weight, minlength=len(edges) + 1)):
            if n:
                name = names[k // 2] if k % 2 else OUTSIDE
                out[name] = out.get(name, 0) + float(n)

    if rule == "share":
        whole = first == last
        give(first[whole])
        for a, b in zip(start[~whole], end[~whole]):
            cuts = np.concatenate([[a], edges[(edges > a) & (edges < b)], [b]])
            give(np.searchsorted(edges, cuts[:-1], side="right"), np.diff(cuts) / (b - a))
    else:
        give(first if rule == "first" else last)
    return out, crossing


def encode(encoding, text: str) -> list[int]:
    """Tokens of a whole text.

    The pattern takes a run of white space at the end of a text whole, and any other without its last character; nothing in front of a run depends on it.
    """
    ids, at = [], 0
    for run in LONG_SPACE.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding.encode_ordinary(text[at:run.start()])
        ids += encoding._encode_single_piece(text[run.start():stop])
        at = stop
    return ids + encoding.encode_ordinary(text[at:])


def count_rows(
    vocabulary: Broadcast, pattern: str, rule: str, sections: Callable[[bytes], list[tuple[str, int, int]]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("n_tokens", pa.int64()), ("n_crossing", pa.int64()), ("sections", pa.map_(pa.string(), pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = vocabulary.value
        encoding = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        width = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            width[rank] = len(token)
        for batch in batches:
            totals, crossings, maps = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                ids = np.array(encode(encoding, text), dtype=np.int64)
                found, crossing = allocate(width[ids], sections(text.encode()), rule)
                totals.append(len(ids))
                crossings.append(crossing)
                maps.append(sorted(found.items()))
            arrays = [pa.array(totals, type=pa.int64()), pa.array(crossings, type=pa.int64()), pa.array(maps, type=schema.field("sections").type)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *schema.names])

    return run


def section_tokens(
    docs: DataFrame, vocabulary: str, pattern: str = PATTERN, rule: str = "first", sections: Callable[[bytes], list[tuple[str, int, int]]] = line_sections,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_crossing, sections (map of name to tokens) per row of ``docs``."""
    if rule not in ("first", "last", "share"):
        raise ValueError(f"unknown rule: {rule}")
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, vocabulary))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(count_rows(ranks, pattern, rule, sections), f"doc_id {rows.dtypes[0][1]}, n_tokens long, n_crossing long, sections map<string,double>")
