"""How far the word use of the sources of a language lies apart, from bitmaps of terms by (group, count).

Every (lang, source) group holds, for each count that terms have in it, a set of term numbers as bits. The bits of two groups, ANDed and
counted, give the number of terms for every pair of counts (the joint cells); a cell times the divergence of its two counts is the cell's
share. Terms that a group lacks are never stored: their cells follow by complement. With z the value of count 0 in a group,

    sum over terms f(p, q) = V f(zp, zq) + sum over levels n (f(p, zq) - f(zp, zq)) + the same for q + sum over joint cells n (f(p, q) - f(p, zq) - f(zp, q) + f(zp, zq)),

so only pairs of counts that occur are touched. Terms are numbered by falling frequency in pieces of 256: a piece of common terms has many counts with
few terms, one of rare terms few counts with many, and both stay small. Sources meet in blocks of 64, so no task holds all of them.

Nulls in text, lang and source count as the empty string; every row is a document, also where rows repeat. A language without kept terms has
value 0 for all its pairs. Texts of any length are read in pieces. Other columns, whatever their names, are not read. Empty input gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunfleet.llm.frames import bounded_batches, joined
from sunfleet.session import written

#: Fixed values of the contract: scale of the probabilities, documents a term needs, terms listed per group.
UNIT, MIN_DOCUMENTS, TOP_TERMS = 1_000_000_000, 3, 200

#: Letters A to Z become small, a to z and all bytes beyond ASCII stay, the rest separates.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Bytes of a text that are split at once; tallies a task holds before it hands them on.
PIECE, HELD = 1 << 20, 300_000

#: Terms of a piece (4 words of 64 bits), sources of a block, and cells of the joint matrix made at once.
TERMS, BLOCK, CELLS = 256, 64, 1 << 19

TALLIES = "lang string, source string, term binary, n bigint, d bigint"
SHARES = "lang string, a int, b int, value bigint"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece."""
    plain, start = text.translate(PLAIN), 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term in every group, added up over the rows of a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for batch in batches:
        for lang, source, text in zip(*batch.columns, strict=True):
            n, d = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            seen: set[bytes] = set()
            for words in terms(text.as_py()):
                n.update(words)
                seen.update(words)
            d.update(seen)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from _tallies(held)
            held = {}
    yield from _tallies(held)


def _tallies(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, d) in held.items():
        if n:
            columns = [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()), pa.array(list(n.values())), pa.array([d[t] for t in n])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "d"])


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def joint_shares(key: tuple, table: pa.Table) -> pa.Table:
    """Shares of the joint cells of all pairs of groups of two blocks, in one piece of terms."""
    lang, _, low, high = (k.as_py() for k in key)
    at = {c: table.column(c).to_numpy() for c in ("ordinal", "p", "z", "w0", "w1", "w2", "w3")}
    order = np.argsort(at["ordinal"], kind="stable")
    at = {c: v[order] for c, v in at.items()}
    bits = np.stack([at[f"w{k}"] for k in range(4)], axis=1).view(np.uint64)
    mine, other = (np.flatnonzero(at["ordinal"] // BLOCK == side) for side in (low, high))
    total = np.zeros((BLOCK, BLOCK), np.int64)
    back = np.zeros((BLOCK, BLOCK), np.int64)
    step = max(1, CELLS // max(1, len(other)))
    for start in range(0, len(mine), step):
        rows = mine[start:start + step]
        cells = np.bitwise_count(bits[rows, None, :] & bits[None, other, :]).sum(-1, dtype=np.int64)
        i, j = np.nonzero(cells)
        n, i, j = cells[i, j], rows[i], other[j]
        apart = at["ordinal"][i] != at["ordinal"][j]
        n, i, j = n[apart], i[apart], j[apart]
        place = (at["ordinal"][i] % BLOCK, at["ordinal"][j] % BLOCK)
        for sums, a, b in ((total, i, j), (back, j, i)) if low != high else ((total, i, j),):
            pa_, pb, za, zb = at["p"][a], at["p"][b], at["z"][a], at["z"][b]
            np.add.at(sums, place, n * (divergence(pa_, pb) - divergence(pa_, zb) - divergence(za, pb) + divergence(za, zb)))
    a, b = np.nonzero(total)
    c, d = np.nonzero(back)
    return pa.table({
        "lang": pa.array([lang] * (len(a) + len(c)), pa.string()),
        "a": pa.array(np.concatenate([a + low * BLOCK, d + high * BLOCK]).astype(np.int32)),
        "b": pa.array(np.concatenate([b + high * BLOCK, c + low * BLOCK]).astype(np.int32)),
        "value": pa.array(np.concatenate([total[a, b], back[c, d]])),
    })


def _probability(count: str, total: str) -> str:
    """In whole numbers of any size; undefined without kept terms."""
    return f"if(v = 0, null, 1 + (cast({count} + 1 as decimal(20, 0)) * {UNIT} div cast({total} + v as decimal(20, 0))))"


def _divergence(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): distance of every source to the others of its language, and the terms it overuses."""
    bounded_batches(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    found = named.mapInArrow(tally, TALLIES)
    tallies = written(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")), "term-tallies")
    totals = tallies.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("d")).filter(F.col("d") >= min_documents)
    by_use = [F.col("lang"), F.col("total").desc(), F.col("term")]
    numbered = totals.repartitionByRange(*by_use).sortWithinPartitions(*by_use).withColumn("number", F.monotonically_increasing_id())
    kept = written(numbered.select("lang", "term", "total", "number"), "kept-terms")
    placed = written(tallies.drop("d").join(kept, ["lang", "term"]), "placed-terms")
    groups = _groups(named, kept, placed)

    held = joined(placed, groups.select("lang", "source", "group_total", "lang_total", "v"), ["lang", "source"])
    over = held.selectExpr("lang", "source", "'term' as part", "term", f"{_probability('n', 'group_total')} as p", f"{_probability('total', 'lang_total')} as q").filter("p > q")
    over = over.selectExpr("lang", "source", "part", "term as item", f"{_divergence('p', 'q')} as value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    over = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    pairs = _pairs(placed, groups).withColumn("rank", F.row_number().over(order))
    out = pairs.unionByName(over)
    return out.select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", F.col("rank").cast("int").alias("rank"))


def _groups(named: DataFrame, kept: DataFrame, placed: DataFrame) -> DataFrame:
    """One row per group: its number in the language, kept words of the group and the language, kept terms, value of count 0."""
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_total"))
    sums = placed.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    found = named.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    found = found.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["v", "lang_total", "group_total"])
    # one row per source of a language
    found = found.selectExpr(
        "*", "cast(row_number() over (partition by lang order by source) - 1 as int) as ordinal",
        f"cast(ceil(count(1) over (partition by lang) / {BLOCK}) as int) as blocks",
    )
    return written(found.selectExpr("*", f"{_probability('0', 'group_total')} as z"), "audit-groups")


def _pairs(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) of every ordered pair of groups of a language."""
    of_group = groups.select("lang", "source", "ordinal", "blocks", "group_total", "v", "z")
    words = [
        f"bit_or(if(number % {TERMS} div 64 = {k}, shiftleft(1L, cast(number % 64 as int)), 0L)) as w{k}" for k in range(TERMS // 64)
    ]
    pieces = placed.groupBy("lang", "source", F.expr(f"number div {TERMS}").alias("piece"), "n").agg(*[F.expr(w) for w in words])
    sets = joined(pieces, of_group, ["lang", "source"]).selectExpr(
        "lang", "piece", "ordinal", f"{_probability('n', 'group_total')} as p", "z", "w0", "w1", "w2", "w3",
        f"ordinal div {BLOCK} as block", "explode(sequence(0, blocks - 1)) as beside",
    ).selectExpr("*", "cast(least(block, beside) as int) as low", "cast(greatest(block, beside) as int) as high")
    joint = sets.groupBy("lang", "piece", "low", "high").applyInArrow(joint_shares, SHARES)

    other = of_group.selectExpr("lang", "ordinal as other", "z as other_z")
    levels = placed.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("size"))
    levels = joined(levels, of_group, ["lang", "source"]).selectExpr("lang", "ordinal", f"{_probability('n', 'group_total')} as p", "z", "size")
    single = joined(levels, other, "lang").filter("ordinal <> other").selectExpr(
        "lang",
        "inline(array("
        f"struct(ordinal as a, other as b, size * cast({_divergence('p', 'other_z')} - {_divergence('z', 'other_z')} as decimal(20, 0)) as value), "
        f"struct(other as a, ordinal as b, size * cast({_divergence('other_z', 'p')} - {_divergence('other_z', 'z')} as decimal(20, 0)) as value)))",
    )
    base = joined(of_group.drop("source"), other, "lang").filter("ordinal <> other").selectExpr(
        "lang", "ordinal as a", "other as b", f"if(v = 0, 0, v * cast({_divergence('z', 'other_z')} as decimal(20, 0))) as value",
    )
    wide = "decimal(38, 0)"
    shares = [f.select("lang", "a", "b", F.col("value").cast(wide).alias("value")) for f in (joint, single, base)]
    summed = shares[0].unionByName(shares[1]).unionByName(shares[2]).groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))
    first = of_group.selectExpr("lang", "ordinal as a", "source")
    second = of_group.selectExpr("lang", "ordinal as b", "cast(source as binary) as item")
    named = joined(joined(summed, first, ["lang", "a"]), second, ["lang", "b"])
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
