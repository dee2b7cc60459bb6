"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame operations only.

1. *Windows.* A window has as many words as a benchmark item. A window can only be similar to an item if they share a
   shingle, so the shingles of all documents are held against those of the items, and a common shingle lays a window of the
   item's size along it. Windows of equal content are one from here on.
2. *Fingerprints.* 64-bit SimHash of the weighted shingles (weight: characters of the shingle's words).
3. *Candidates.* Fingerprints are cut into four blocks of 16 bits. Within Hamming distance 19, one block is within 4 (pigeonhole), so
   the items are listed under every value within 4 flips of their blocks and windows of the same size look theirs up.
   Every pair within the radius is found.
4. *Verification.* Weighted Jaccard similarity of the two multisets of shingles, in whole numbers.

Defined cases: null and short texts have no shingle and match nothing; so do items of fewer words than a shingle. A document
shorter than an item is compared as a whole. Repeated items and rows give the same matches. Rows are compared one by one, also those
that repeat a doc_id or have none: ``matches`` names the best window of all rows of a doc_id (null is one), ``clean`` removes the leaking rows alone.
A null item_id is a key like any other. Words are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunfleet.llm.frames import fresh, identified, joined, small
from sunfleet.session import written

SHINGLE, PERCENT = 5, 80
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 4, 16, 4
#: Every pair of fingerprints up to this distance is compared.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1

WORDS = "filter(split(lower({text}), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"


def shingle_hashes(words: str, size: int) -> str:
    """Hashes of all shingles of an array of words; none if there are fewer words."""
    return f"if(size({words}) < {size}, cast(array() as array<bigint>), transform(sequence(1, size({words}) - {size - 1}), i -> xxhash64(slice({words}, i, {size}))))"


def weighted(words: str, start: str, count: str, size: int) -> str:
    """(hash, weight) of ``count`` shingles from word ``start`` (from 1) on."""
    weight = f"cast(aggregate(slice({words}, i, {size}), 0, (acc, w) -> acc + length(w)) as bigint)"
    return f"transform(sequence({start}, {start} + {count} - 1), i -> struct(xxhash64(slice({words}, i, {size})) as h, {weight} as w))"


def simhash(shingles: str) -> str:
    vote = "aggregate({0}, 0L, (acc, x) -> acc + if((shiftright(x.h, b) & 1L) = 1L, x.w, -x.w)) > 0".format(shingles)
    return f"aggregate(sequence(0, 63), 0L, (bits, b) -> bits | if({vote}, shiftleft(1L, b), 0L))"


def blocks(fingerprint: str) -> Column:
    parts = ", ".join(f"struct({k} as block, cast(shiftrightunsigned({fingerprint}, {BLOCK_BITS * k}) & {2**BLOCK_BITS - 1}L as int) as value)" for k in range(BLOCKS))
    return F.explode(F.expr(f"array({parts})"))


def shared_weight(a: str, b: str) -> str:
    """Weight that two multisets of shingles have in common."""
    count = "size(filter({0}, y -> y.h = x.h))"
    return f"aggregate(array_distinct({a}), 0L, (acc, x) -> acc + x.w * least({count.format(a)}, {count.format(b)}))"


def total_weight(a: str) -> str:
    return f"aggregate({a}, 0L, (acc, x) -> acc + x.w)"


def windows(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """(id, start, length): windows of item size that share a shingle with an item at the same place."""
    seeds = items.selectExpr("length", f"posexplode({shingle_hashes('words', size)}) as (at, h)").distinct()
    seeds = written(seeds, "seeds")
    shingles = docs.selectExpr("id", "size(words) as n", f"posexplode({shingle_hashes('words', size)}) as (pos, h)")
    met = shingles.join(F.broadcast(seeds) if small(seeds) else seeds, "h")
    # a window stays inside its document
    return met.selectExpr("id", "length", "cast(greatest(0, least(pos - at, n - length)) as int) as start").distinct()


def hits(
    docs: DataFrame, number: str, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
    text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id, start, length, item_id, similarity): windows ``percent`` similar to an item or more; ``number`` is the column of unique row ids."""
    texts = docs.selectExpr(f"`{number}` as id", f"{WORDS.format(text=f'`{text_column}`')} as words")
    listed = items.selectExpr(f"`{item_column}` as item_id", f"{WORDS.format(text=f'`{item_text}`')} as words").filter(f"size(words) >= {shingle}")
    listed = listed.selectExpr("item_id", "words", "size(words) as length")
    found = written(windows(texts.filter(f"size(words) >= {shingle}"), listed, shingle), "windows")
    per_doc = written(found.groupBy("id").agg(F.collect_set(F.struct("start", "length")).alias("at")), "windows")
    laid = joined(texts, per_doc, "id").selectExpr("id", "words", "explode(at) as at").selectExpr("id", "at.start as start", "at.length as length", "words")
    count = f"greatest(1, least(length, size(words) - start) - {shingle - 1})"
    laid = laid.filter(f"size(words) - start >= {shingle}").selectExpr("id", "start", "length", f"{weighted('words', 'start + 1', count, shingle)} as s")
    laid = written(laid.selectExpr("id", "start", "length", "s", "xxhash64(s.h) as content"), "windows")
    contents = laid.groupBy("length", "content").agg(F.min("s").alias("s"))
    contents = written(contents.selectExpr("length", "content", "s", f"{simhash('s')} as f"), "fingerprints")
    known = listed.selectExpr("item_id", "length", f"{weighted('words', '1', f'length - {shingle - 1}', shingle)} as t").distinct()
    known = written(known.selectExpr("item_id", "length", "t", f"{simhash('t')} as g"), "items")
    near = f"filter(sequence(0, {2**BLOCK_BITS - 1}), x -> bit_count(x) <= {BLOCK_RADIUS})"
    flips = known.sparkSession.range(1).selectExpr(f"{near} as flips")  # 2517 values
    index = known.select("item_id", "length", "g", blocks("g").alias("b")).join(F.broadcast(flips))
    index = index.selectExpr("item_id", "length", "g", "b.block as block", "explode(transform(flips, x -> x ^ b.value)) as value")
    look = contents.select("length", "content", "f", blocks("f").alias("b")).selectExpr("length", "content", "f", "b.block as block", "b.value as value")
    pairs = look.join(index, ["length", "block", "value"]).filter(f"bit_count(f ^ g) <= {RADIUS}").select("length", "content", "item_id").distinct()
    both = pairs.join(contents.select("length", "content", "s"), ["length", "content"])
    both = both.alias("p").join(known.alias("k"), F.expr("p.item_id <=> k.item_id and p.length = k.length"))
    weighed = both.selectExpr("p.length", "p.content", "p.item_id", f"{shared_weight('t', 's')} as common", f"{total_weight('s')} + {total_weight('t')} as total")
    good = weighed.filter(f"100 * common >= {percent} * (total - common)").selectExpr("length", "content", "item_id", "common / cast(total - common as double) as similarity")
    return joined(laid.select("id", "start", "length", "content"), written(good, "matches"), ["length", "content"])


def matches(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_column: str = "doc_id", **columns) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): the best window of each document and item, ``percent`` similar or more."""
    rows, number = identified(docs, id_column)
    found = written(hits(rows, number, items, shingle, percent, **columns).groupBy("id", "item_id").agg(F.max(F.struct("similarity", F.expr("-start as start"), "length")).alias("m")), "hits")
    # the rows of one id are one document
    leaks = rows.select(F.col(number).alias("id"), F.col(f"`{id_column}`").cast("long").alias("doc_id"))
    best = joined(leaks, found, "id").groupBy("doc_id", "item_id").agg(F.max("m").alias("m"))
    return best.selectExpr("doc_id", "item_id", "m.similarity as similarity", "-m.start as start", "m.length as n_words")


def clean(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows without a match, with their columns."""
    rows, number = identified(docs, id_column)
    leak = fresh(rows, "leak")
    leaks = written(hits(rows, number, items, **options).select(F.col("id").alias(leak)).distinct(), "leaks")
    side = F.broadcast(leaks) if small(leaks) else leaks
    return rows.join(side, rows[number] == side[leak], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
