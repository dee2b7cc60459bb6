"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Sources get targets in words: their weights share ``percent`` of all words, no target is above ``most`` times its
source, and what is cut off is shared again by weight until no target is above. A document is expected
``target / source size`` times. Within a source the documents stand in order of size, the expected copies are summed from
the first on, one random offset is added, and a document is taken once for every whole number its step crosses.
In order of size, neighbours replace each other, so the words taken stay close to the target.

The place of a document is its rank within a bin of (source, size, hash) plus the documents of earlier bins. Bins are small
whatever the source, so a source with a third of all rows is spread over many tasks.

Defined cases: null text has size 0 and no words to take; a null source is a source of its own, last in order. A source without
words has target 0. Repeated rows are documents of their own, ties in size are broken by a hash of the id. A null doc_id is
hashed as null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunfleet.llm.frames import fresh, small
from sunfleet.session import written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Rows of a bin, about, beyond which sizes are split by hash.
BIN_ROWS = 20_000

GAP, WORD = "[\\\\x20\\\\x09-\\\\x0D]", "[^\\\\x20\\\\x09-\\\\x0D]"


def word_count(text: str) -> str:
    """Runs without ASCII white space: each becomes one letter, together with the white space around it."""
    return f"cast(if({text} rlike '{WORD}', length(regexp_replace({text}, '{GAP}*+{WORD}++{GAP}*+', 'a')), 0) as bigint)"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = 150, most: int = 2) -> DataFrame:
    """(source, source_size, weight, target) from one row (source, source_size) per source.

    The targets fill up like joined vessels: a source whose cap is reached at a lower level (cap / weight) than the
    common one stays at its cap, the others share the rest by weight.
    """
    listed = ", ".join(map(str, weights))
    ranked = sizes.selectExpr("source", "source_size", f"element_at(array({listed}), cast((row_number() over (order by source asc nulls last) - 1) % {len(weights)} as int) + 1) as weight")
    level = ranked.selectExpr("*", f"{most} * cast(source_size as double) / weight as level", f"sum(source_size) over () * {percent} / 100D as volume")
    filled = level.selectExpr(
        "*",
        f"coalesce(sum({most} * source_size) over (order by level, source nulls last rows between unbounded preceding and 1 preceding), 0) as below",
        "sum(weight) over (order by level, source nulls last rows between current row and unbounded following) as open",
    )
    # the level of the open sources: the first at which the rest, shared with the later ones, stays below its cap;
    # from there on the shares only fall, so it is the largest
    common = "max(case when (volume - below) / open <= level then (volume - below) / open end) over (order by level, source nulls last rows between unbounded preceding and unbounded following)"
    return filled.selectExpr("*", f"{common} as common").selectExpr(
        "source", "source_size", "weight", f"case when source_size = 0 then 0D when common is null or level < common then cast({most} * source_size as double) else common * weight end as target"
    )


def size_bin(size: str) -> str:
    """Sizes in order, in bins of a 64th of their power of two."""
    power = f"cast(floor(log2(greatest({size}, 1))) as bigint)"
    return f"if({size} < 64, {size}, 64 * ({power} - 5) + shiftright({size}, cast({power} - 6 as int)) - 64)"


def copies(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = 150, most: int = 2, seed: int = 7,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies; and the columns ``carry`` as a struct ``row``."""
    base = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
        F.coalesce(F.expr(word_count(f"`{text_column}`")), F.lit(0)).alias("size"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )
    if not carry:
        base = written(base, "sizes")  # the texts are read once
    salted = base.withColumns({
        "bin": F.expr(size_bin("size")),
        "salt": F.expr(f"md5(concat(coalesce(cast(doc_id as string), 'null'), ':{seed}'))"),
    }).withColumn("slot", F.expr("cast(conv(substr(salt, 1, 3), 16, 10) as int)"))
    counted = written(salted.groupBy("source", "bin", "slot").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "bins")
    shares = targets(counted.groupBy("source").agg(F.sum("words").alias("source_size")), weights, percent, most)
    # a crowded bin is split into parts by hash, a power of two of them; slots tell how many rows each part has
    crowd = counted.groupBy("source", "bin").agg(F.sum("n").alias("rows"))
    crowd = crowd.selectExpr("source as of", "bin as in_bin", f"cast(least(12, greatest(0, ceil(log2(rows / {BIN_ROWS}D)))) as int) as bits")
    parts = counted.join(crowd, F.expr("source <=> of and bin = in_bin")).groupBy("of", "in_bin", "bits", F.expr("shiftright(slot, 12 - bits)").alias("part")).agg(F.sum("n").alias("n"))
    ahead = parts.selectExpr("*", "coalesce(sum(n) over (partition by of order by in_bin, part rows between unbounded preceding and 1 preceding), 0L) as before")
    bins = ahead.groupBy("of", "in_bin", "bits").agg(F.expr("map_from_entries(collect_list(struct(part, before)))").alias("ahead"))  # 4096 parts at most
    plan = written(bins.join(shares, F.expr("of <=> source")).select("of", "in_bin", "bits", "ahead", "source_size", "target"), "mix")
    layout = salted.join(F.broadcast(plan) if small(plan) else plan, F.expr("source <=> of and bin = in_bin"))
    layout = layout.withColumn("part", F.expr("shiftright(slot, 12 - bits)"))
    # rows that are equal so far are told apart by all their columns where these are given back
    last = ", xxhash64(row)" if carry else ""
    placed = layout.withColumn("place", F.expr(f"element_at(ahead, part) + row_number() over (partition by source, bin, part order by size, salt, doc_id{last})"))
    offset = f"cast(conv(substr(md5(concat(coalesce(source, ''), ':{seed}')), 1, 5), 16, 10) as bigint) / 1048576D"
    step = "if(source_size > 0, target / source_size, 0D)"
    taken = f"least({most}L, cast(floor({offset} + {step} * place) - floor({offset} + {step} * (place - 1)) as bigint))"
    return placed.selectExpr("doc_id", "source", "size", "source_size", "target", f"{taken} as copies", *(["row"] if carry else []))


def mixed(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the number of the copy in ``copy``."""
    number = fresh(docs, "copy")
    rows = copies(docs, text_column=text_column, carry=docs.columns, **options).filter("copies > 0")
    repeated = rows.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("times"))
    return repeated.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("times").alias(number))
