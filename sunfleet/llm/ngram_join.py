"""Similarity join on word shingles by parity sketches.

Two documents link when ``100 * intersection >= percent * union`` of their shingle sets.

1. *Sketch.* A set of size n falls into a size band. Every shingle is XORed, as a 64-bit hash, into one block of
   the sketch, so two sketches differ in at most as many blocks as the symmetric difference of the sets has
   members (with a single bit per shingle, blocks of few shingles would look alike in unrelated sets). In a
   band, linked sets differ in at most ``D`` shingles, and the band has m > D blocks: linked sets agree on
   m - D whole blocks (pigeonhole). A set that a larger partner may pull into the next band is sketched there as well.
2. *Join.* Equal blocks meet by (block key, set). Linked sets agree on more than one block, so every set leaves out its most
   crowded ones, as many as that allows (prefix filter). Each set links to the smallest set of its
   block: linear in the group, never all pairs. Empty blocks say nothing and are left out: m is chosen so that a set has
   fewer of them than m - D, and so one of the blocks it agrees on is not empty. A set with more empty blocks (a
   small one, as a rule) meets the other holders of each by a second sketch with other hashes.
3. *Verify.* The links' connected components hold every candidate pair. Inside a component the exact
   intersections of all sets are counted; large components are cut into cells of bounded size, one task each.
4. *Classes.* Verified links give the components that are returned.

Equal sets are one class from the start; only one document per class is compared.

Defined cases: null or blank text has an empty set and links with nothing. A null doc_id takes part, but is never
the id of a component that has another id. Rows that repeat a doc_id are documents of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunfleet.llm.frames import identified, joined, small
from sunfleet.llm.graph import components
from sunfleet.llm.kernels import LOWER, SpanHash, flat, lists, mix, ranges, shingles, slices, words
from sunfleet.session import written

#: Sets compared in one cell, and sets in one bundle of small components.
CELL, BUNDLE = 512, 2048
#: Shingles per slab of the 0/1 matrix.
SLAB = 4096

SKETCHED = "doc_id long, n long, set long, check long"


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, row), distinct and sorted within a row; a shorter text is one shingle as a whole."""
    data, starts, ends = flat(column)
    data = LOWER[data]
    start, end, row = words(data, starts, ends)
    word = SpanHash(data)(start, end)
    value, at, _ = shingles(word, row, size)
    count = np.bincount(row, minlength=len(starts))
    for n in range(1, size):  # texts of fewer words
        short, where, _ = shingles(word, row, n)
        pick = count[where] == n
        value, at = np.concatenate([value, mix(short[pick], 100 + n)]), np.concatenate([at, where[pick]])
    by = np.lexsort((value, at))
    value, at = value[by], at[by]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1])
    return value[new], at[new]


class Bands:
    """Size bands: largest set, smallest set, largest difference of linked sets and blocks of each."""

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        share = percent / 100
        steps = 3 if percent >= 90 else 2
        ratio = 1 / share**steps if percent < 100 else 1.5
        high, edges = 1, [0, 1]
        while high < largest:
            high = max(high + 1, math.floor(high * ratio))
            edges.append(high)
        self.high = np.array(edges[1:], dtype=np.int64)
        self.low = np.array(edges[:-1], dtype=np.int64) + 1
        # |A| + |B| <= 2 high and intersection >= percent / (100 + percent) of it
        self.difference = 2 * self.high * (100 - percent) // (100 + percent)
        # blocks per D + 1: the smallest set of a band has about exp(-shingles per block) empty blocks, which must stay below m - D
        more = 1.05
        if percent < 100:
            fill = share / ratio * (1 + share) / (2 * (1 - share))
            while more < 3 and more * math.exp(-fill / more) > 0.7 * (more - 1):
                more += 0.05
        self.blocks = np.ceil(more * (self.difference + 1)).astype(np.int64) + 1

    def of(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into n, band): the own band, and those above that a larger partner may be in."""
        band = np.searchsorted(self.high, n)
        top = np.searchsorted(self.high, np.minimum(n * 100 // self.percent, self.high[-1]))
        count = top - band + 1
        return np.repeat(np.arange(len(n)), count), ranges(band, count)


def block_keys(value: np.ndarray, start: np.ndarray, n: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the set, block key, tag). Sets whose band allows no difference link with equal sets only and have no key.

    The tag is the band and, in its lower half, how many keys of the set and band may be left out: linked sets agree on
    m - D blocks, of which at most the empty ones are not keys, so they share more keys than that.
    """
    owner, band = bands.of(n)
    able = bands.difference[band] > 0
    owner, band = owner[able], band[able]
    sketch, first, blocks = _sketch(value, start[owner], n[owner], bands.blocks[band], 0)
    of = np.repeat(np.arange(len(owner)), blocks)
    key = mix(sketch ^ mix((band[of] * 2**32 + ranges(np.zeros(len(blocks), dtype=np.int64), blocks)).astype(np.uint64), 11), 12)
    empty = sketch == 0
    spare = blocks - bands.difference[band] - np.bincount(of[empty], minlength=len(owner)) - 1
    many = spare < 0
    tag = band * 2**32 + np.maximum(spare, 0)
    bare = np.flatnonzero(empty & many[of])
    again = of[bare]
    second, _, more = _sketch(value, start[owner[again]], n[owner[again]], blocks[again], 1)
    into = np.repeat(np.arange(len(again)), more)
    inner = ranges(np.zeros(len(more), dtype=np.int64), more).astype(np.uint64)
    second = mix(second ^ mix(key[bare[into]] + inner, 13), 14)
    full = of[~empty]
    return np.concatenate([owner[full], owner[again[into]]]), np.concatenate([key[~empty], second]), np.concatenate([tag[full], tag[again[into]]])


def _sketch(value, start, n, blocks, seed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parity of the shingles' bits per block, blocks of all sets one after another."""
    first = np.cumsum(blocks) - blocks
    token = mix(value, 21 + seed)[ranges(start, n)]
    at = np.repeat(first, n) + (mix(token, 23) % np.repeat(blocks, n).astype(np.uint64)).astype(np.int64)
    sketch = np.zeros(int(blocks.sum()), dtype=np.uint64)
    np.bitwise_xor.at(sketch, at, token)
    return sketch, first, blocks


def _sums(value: np.ndarray, row: np.ndarray, n_rows: int, seed: int) -> np.ndarray:
    """Order-free 64-bit hash of a set: the sum of its mixed members."""
    sums = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(mix(value, seed), out=sums[1:])
    ends = np.searchsorted(row, np.arange(n_rows), side="right")
    starts = np.searchsorted(row, np.arange(n_rows), side="left")
    return mix(sums[ends] - sums[starts], seed)


def size_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, n, set, check) of the rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                value, row = shingle_sets(piece.column("text"), size)
                n = np.bincount(row, minlength=piece.num_rows)
                whole, check = (pa.array(_sums(value, row, piece.num_rows, seed).view(np.int64)) for seed in (31, 32))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n), whole, check], names=["doc_id", "n", "set", "check"])

    return run


def key_rows(size: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(set, key, tag) of the rows (doc_id, text), once per set and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        bands = Bands(percent, 1 << 34)
        for batch in batches:
            for piece in slices(batch, "text"):
                value, row = shingle_sets(piece.column("text"), size)
                n = np.bincount(row, minlength=piece.num_rows)
                start = np.cumsum(n) - n
                whole = _sums(value, row, piece.num_rows, 31).view(np.int64)
                if len(seen) > 1_000_000:
                    seen.clear()
                ask = []
                for i in np.flatnonzero(n):
                    if int(whole[i]) not in seen:
                        seen.add(int(whole[i]))
                        ask.append(i)
                ask = np.array(ask, dtype=np.int64)
                owner, key, tag = block_keys(value, start[ask], n[ask], bands)
                for cut in range(0, len(key), 1 << 16):
                    part = slice(cut, cut + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(whole[ask[owner[part]]]), pa.array(key[part].view(np.int64)), pa.array(tag[part])], names=["set", "key", "tag"])

    return run


def set_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows (text, set, ...) whose text has the set asked for, with its shingles instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                value, row = shingle_sets(piece.column("text"), size)
                whole = _sums(value, row, piece.num_rows, 31).view(np.int64)
                wanted = np.flatnonzero(whole == piece.column("set").to_numpy())
                n = np.bincount(row, minlength=piece.num_rows)
                start = np.cumsum(n) - n
                found = lists(value.view(np.int64)[ranges(start[wanted], n[wanted])], n[wanted], pa.int64())
                rest = piece.drop_columns(["text"]).take(pa.array(wanted))
                yield pa.RecordBatch.from_arrays([*rest.columns, found], names=[*rest.schema.names, "shingles"])

    return run


def linked_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of links between the sets (not with themselves)."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    _, member, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[member] > 1
    owner, member = owner[shared], member[shared]
    rank = np.cumsum(count > 1) - 1
    member = rank[member]
    common = np.zeros((len(sets), len(sets)), dtype=np.float64)
    by = np.argsort(member, kind="stable")
    owner, member = owner[by], member[by]
    total = int(member[-1]) + 1 if len(member) else 0
    for low in range(0, total, SLAB):
        a, b = np.searchsorted(member, [low, low + SLAB])
        slab = np.zeros((len(sets), min(SLAB, total - low)), dtype=np.float32)
        slab[owner[a:b], member[a:b] - low] = 1
        common += slab @ slab.T
    linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    np.fill_diagonal(linked, False)
    return linked


def verify(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links (a, b) and link counts of one cell, which holds whole components or two parts of one.

    Rows: set, part, comp, copies, shingles, both (whether the cell is of two different parts: then only pairs
    across the parts are its own). ``a = b`` carries the number of linked documents of a set.
    """

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        # rows that repeat an id may bring a set twice
        for _, comp in cell.drop_duplicates("set").groupby("comp", sort=False):
            ids, copies = comp["set"].to_numpy(), comp["copies"].to_numpy()
            linked = linked_pairs([np.asarray(s) for s in comp["shingles"]], percent)
            part = comp["part"].to_numpy()
            if comp["both"].iloc[0]:
                linked &= part[:, None] != part[None, :]
            total = linked @ copies
            out += [(int(i), int(i), int(t)) for i, t in zip(ids, total)]
            # a forest of the links: a set and its first neighbour in the order of a search
            root = np.full(len(ids), -1)
            for first in range(len(ids)):
                if root[first] >= 0:
                    continue
                root[first], todo = first, [first]
                while todo:
                    more = np.flatnonzero(linked[todo].any(axis=0) & (root < 0))
                    root[more] = first
                    todo = more.tolist()
            out += [(int(ids[i]), int(ids[r]), 0) for i, r in enumerate(root) if i != r]
        return pd.DataFrame(out, columns=["a", "b", "links"])

    return run


def similarity_components(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links (linked documents, copies included).

    ``percent`` is 75 or more: below, a sketch would need more blocks than a set has shingles.
    """
    if percent < 75:
        raise ValueError("percent must be 75 or more")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    sketched = written(rows.mapInArrow(size_rows(shingle), SKETCHED), "sketches")
    classes = sketched.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    # every set leaves out its most crowded blocks, as many as it may: two sets that share k keys share one among all but
    # the k - 1 that come first in a common order; what many documents have in common thus brings nobody together
    keys = rows.mapInArrow(key_rows(shingle, percent), "set long, key long, tag long")
    crowded = keys.selectExpr("*", "count(*) over (partition by key) as crowd").filter("crowd > 1")
    ranked = crowded.selectExpr("set", "key", "tag & 4294967295L as spare", "dense_rank() over (partition by set, tag order by crowd desc, key) as place")
    # sets that share a block, each with the smallest set of the block
    met = ranked.filter("place > spare").selectExpr("set", "first_value(set) over (partition by key order by set) as first")
    near = written(met.filter("set <> first").selectExpr("set as a", "first as b").distinct(), "candidates")
    groups = components(near)
    known = written(groups.withColumnRenamed("node", "set").join(classes, "set"), "sets")
    sizes = known.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    plan = joined(known, written(sizes, "sizes"), "root").withColumn("parts", F.expr(f"cast(ceil(size / {CELL}) as int)"))
    plan = plan.withColumn("part", F.expr("cast(pmod(xxhash64(set, 5L), parts) as int)"))
    wanted = written(plan.selectExpr("low as doc_id", "set", "root as comp", "copies", "parts", "part"), "wanted")
    # the sets of the wanted documents, from their texts; a large component's go to the cells of their part with every part
    ask = wanted.withColumnRenamed("doc_id", "id")
    texts = _null_safe(rows.withColumnRenamed("doc_id", "id"), ask)
    sets = texts.mapInArrow(set_rows(shingle), "set long, comp long, copies long, parts int, part int, shingles array<long>")
    bundles = max(1, math.ceil(wanted.filter("parts = 1").count() / BUNDLE))
    cells = sets.selectExpr("*", "explode(sequence(0, parts - 1)) as other").selectExpr(
        "set", "comp", "copies", "part", "shingles", "part <> other as both",
        f"if(parts = 1, pmod(xxhash64(comp, 7L), {bundles}), xxhash64(comp, least(part, other))) as x", "if(parts = 1, -1, greatest(part, other)) as y",
    )
    links = cells.groupBy("x", "y").applyInPandas(verify(percent), "a long, b long, links long")
    links = written(links, "links")
    counts = links.filter("a = b").groupBy("a").agg(F.sum("links").alias("linked"))
    roots = components(links.filter("a <> b").select("a", "b"))
    result = classes.join(roots.withColumnRenamed("node", "set"), "set", "left").join(counts.withColumnRenamed("a", "set"), "set", "left")
    result = written(result.selectExpr("set", "low", "copies", "coalesce(root, set) as root", "coalesce(linked, 0L) as linked"), "classes")
    first = result.groupBy("root").agg(F.min("low").alias("component"))
    result = written(result.join(first, "root").select("set", "component", F.expr("linked + copies - 1").alias("n_links")), "classes")
    full = joined(sketched.select("doc_id", "n", "set"), result, "set", "left")
    return full.selectExpr(
        "doc_id", "n as n_shingles", "case when n = 0 then doc_id else component end as component_id", "case when n = 0 then 0L else n_links end as n_links"
    )


def _null_safe(rows: DataFrame, ask: DataFrame) -> DataFrame:
    """Rows whose id is asked for, a null id included."""
    marked = written(ask.withColumn("id", F.expr("coalesce(id, -9223372036854775808L)")), "ask")
    keyed = rows.selectExpr("coalesce(id, -9223372036854775808L) as id", "text")
    return joined(keyed, marked, "id").drop("id")


def one_per_component(docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that link, over any number of steps, to a row with a smaller id; columns as they are."""
    rows, number = identified(docs, id_column)
    found = similarity_components(rows, shingle, percent, number, text_column)
    gone = written(found.filter("doc_id <> component_id").selectExpr("doc_id as gone"), "gone")
    side = F.broadcast(gone) if small(gone) else gone
    return rows.join(side, rows[number] == side["gone"], "left_anti").drop(number)
