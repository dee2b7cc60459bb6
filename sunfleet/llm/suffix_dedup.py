"""Exact substring deduplication with suffix arrays of grouped contexts.

Every byte covered by a string of ``length`` bytes that also starts earlier (smaller doc_id, or the
same document and an earlier start) is removed. Strings are judged on the input.

1. *Anchors.* Each window of ``length`` bytes is represented by its smallest 32-byte string (by hash,
   leftmost). Equal windows have equal anchors at equal offsets, so windows meet by their anchor. The
   consecutive windows of one anchor form a *context*.
2. *Grouping.* One shuffle of (anchor, context hash, document, position) by anchor. Copies of a
   context are combined per slice before it, so a passage in a third of all documents sends few rows.
   A context that occurred earlier is a duplicate as a whole. First occurrences are compared further
   if their anchor has other contexts; anchors with one context end here.
3. *Suffix arrays.* The contexts of an anchor are trimmed to what any two of them can share and
   sorted as suffixes by linear grouping (``grouping_sort``). Neighbours that agree on ``length``
   bytes form runs; all windows of a run but the earliest are duplicates. Agreement is by 64-bit hash.
   Anchors with more than ``most`` contexts send no text: each of their windows is a row (hash, document, position), the earliest
   of each hash is found by an aggregate that combines copies before the shuffle, and a join that skew handling can split marks the others.
4. *Spans.* Duplicate windows are merged per document and cut from its bytes.

Defined cases: a null text counts as empty, a null doc_id comes after all others. Where ids repeat or are missing the documents are numbered, in
the order of id and SHA-256 of the text; rows with equal id and text are one document and get equal results.
A document shorter than ``length`` keeps all its bytes. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunfleet.llm.frames import fresh
from sunfleet.llm.grouping_sort import suffix_arrays
from sunfleet.llm.kernels import SpanHash, flat, mix, ranges, rows_of, slices, slide_min
from sunfleet.session import written

GRAM = 32
#: Bytes of context text sorted together.
SORT_BYTES = 1 << 20
#: Steps in which shared context is measured.
STEP = 4
LAST = 2**63 - 1

FOUND = "anchor long, context long, id long, place long, windows int, offset int"
MARKS = "id long, place long, windows int"


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of adjacent equal keys begins."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """First place of the minimum of every run of ``width`` values."""
    smallest = slide_min(values, width)
    edge = np.zeros(width - 1, dtype=np.uint64)
    highest = ~slide_min(~np.concatenate([edge, smallest, edge]), width)  # of the runs that hold a place
    places = np.flatnonzero(values <= highest)  # those that are the minimum of some run
    at = np.searchsorted(places, np.arange(len(smallest)))
    todo = np.flatnonzero(values[places[at]] != smallest)
    while len(todo):
        at[todo] += 1
        todo = todo[values[places[at[todo]]] != smallest[todo]]
    return places[at]


def contexts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, row, first window within the row, windows, offset of the anchor)."""
    window = np.arange(max(0, len(data) - length + 1))
    window = window[window + length <= ends[rows_of(window, ends)]]
    if not len(window):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    spans = SpanHash(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = spans(at, at + GRAM)
    chosen = leftmost_minima(gram, length - GRAM + 1)[window]
    new = np.flatnonzero(_runs(chosen, window - np.arange(len(window))))
    low, anchor, windows = window[new], chosen[new], np.diff(np.append(new, len(window)))
    row = rows_of(low, ends)
    offset = anchor - low
    context = spans.raw(low, low + windows - 1 + length) + offset.astype(np.uint64) + (windows.astype(np.uint64) << np.uint64(8))
    return gram[anchor], mix(context, 1), row, low - starts[row], windows, offset


def merged(ids: np.ndarray, place: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join runs of windows of a document that touch or overlap."""
    by = np.lexsort((place, ids))
    ids, place, stop = ids[by], place[by], (place + windows)[by]
    if not len(ids):
        return ids, place, windows
    new = _runs(ids)
    reach = stop.copy()
    # running maximum of the ends within a document: documents are lifted apart by their rank
    rank = np.cumsum(new) - 1
    order = np.argsort(reach, kind="stable")
    position = np.empty(len(reach), dtype=np.int64)
    position[order] = np.arange(len(reach))
    lifted = np.maximum.accumulate(rank * len(reach) + position) - rank * len(reach)
    reach = reach[order][lifted]
    new[1:] |= place[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    return ids[first], place[first], reach[last] - place[first]


def find_contexts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts of the rows (id, part, text); copies within a slice as duplicates, without an offset."""
    schema = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("id", pa.int64()), ("place", pa.int64()), ("windows", pa.int32()), ("offset", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                ids, part = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("id", "part"))
                anchor, context, row, low, windows, offset = contexts(*flat(piece.column("text")), length)
                ids, place = ids[row], (part[row] << 32) + low
                by = np.lexsort((place, ids, context, anchor))
                again = ~_runs(anchor[by], context[by])
                # the same document twice in one slice: one of its rows is enough
                again &= _runs(ids[by], place[by])
                lead, copy = by[_runs(anchor[by], context[by])], by[again]
                copy_id, copy_place, copy_windows = merged(ids[copy], place[copy], windows[copy])
                columns = (
                    np.concatenate([anchor[lead], mix(copy_id.astype(np.uint64), 2)]).view(np.int64),
                    np.concatenate([context[lead], np.zeros(len(copy_id), dtype=np.uint64)]).view(np.int64),
                    np.concatenate([ids[lead], copy_id]),
                    np.concatenate([place[lead], copy_place]),
                    np.concatenate([windows[lead], copy_windows]).astype(np.int32),
                    np.concatenate([offset[lead], np.full(len(copy_id), -1)]).astype(np.int32),
                )
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _wanted(piece: pa.RecordBatch, starts: np.ndarray, *names: str) -> tuple[np.ndarray, ...]:
    """Row, first byte and ``names`` of the wanted contexts of the rows (id, part, text, wanted)."""
    wanted = piece.column("wanted")
    row = np.repeat(np.arange(piece.num_rows), np.diff(wanted.offsets.to_numpy()))
    place, *rest = (wanted.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("place", *names))
    return row, starts[row] + (place & 0xFFFFFFFF), place, *rest


def fetch_contexts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bytes of the wanted contexts of the rows (id, part, text, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                data, starts, _ = flat(piece.column("text"))
                ids = piece.column("id").to_numpy(zero_copy_only=False)
                row, low, place, anchor, windows, offset = _wanted(piece, starts, "anchor", "windows", "offset")
                size = windows - 1 + length
                bounds = np.zeros(len(size) + 1, dtype=np.int64)
                np.cumsum(size, out=bounds[1:])
                body = data[ranges(low, size)] if len(size) else data[:0]
                for cut in range(0, len(size), 8192):  # keeps the batches small
                    stop = min(cut + 8192, len(size))
                    local = (bounds[cut: stop + 1] - bounds[cut]).astype(np.int32)
                    text = pa.Array.from_buffers(pa.binary(), stop - cut, [None, pa.py_buffer(local.tobytes()), pa.py_buffer(body[bounds[cut]: bounds[stop]].tobytes())])
                    arrays = [pa.array(anchor[cut:stop]), pa.array(ids[row[cut:stop]]), pa.array(place[cut:stop]), pa.array(windows[cut:stop].astype(np.int32)), pa.array(offset[cut:stop].astype(np.int32)), text]
                    yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "id", "place", "windows", "offset", "text"])

    return run


def fetch_windows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hash and place of each window of the wanted contexts of the rows (id, part, text, wanted); copies within a slice as duplicates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                data, starts, _ = flat(piece.column("text"))
                ids = piece.column("id").to_numpy(zero_copy_only=False)
                row, low, place, n = _wanted(piece, starts, "windows")
                step = ranges(np.zeros(len(n), dtype=np.int64), n)
                low, place, ids = np.repeat(low, n) + step, np.repeat(place, n) + step, np.repeat(ids[row], n)
                window = mix(SpanHash(data)(low, low + length), 3).view(np.int64) if len(low) else low
                by = np.lexsort((place, ids, window))
                lead = _runs(window[by])
                copy_id, copy_place, copy_windows = merged(ids[by[~lead]], place[by[~lead]], np.ones(len(by) - int(lead.sum()), dtype=np.int64))
                by = by[lead]
                window = pa.concat_arrays([pa.array(window[by], type=pa.int64()), pa.nulls(len(copy_id), pa.int64())])
                rest = (np.concatenate([ids[by], copy_id]), np.concatenate([place[by], copy_place]), np.concatenate([np.ones(len(by), dtype=np.int64), copy_windows]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([window, *map(pa.array, rest)], names=["window", "id", "place", "windows"])

    return run


def merge_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join runs of windows that touch, batch by batch."""
    for batch in batches:
        ids, place, windows = merged(*(c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(place), pa.array(windows.astype(np.int32))], names=["id", "place", "windows"])


def _shared(group: np.ndarray, spans: SpanHash, at: np.ndarray, room: np.ndarray, ahead: bool) -> np.ndarray:
    """Upper bound of the bytes after (or before) ``at`` that a context shares with another of its group."""
    bound = room.copy()
    alive = np.arange(len(at))
    for size in range(STEP, int(room.max(initial=0)) + STEP, STEP):
        alive = alive[room[alive] >= size]
        if not len(alive):
            break
        p = at[alive]
        value = spans(p, p + size) if ahead else spans(p - size, p)
        by = np.lexsort((value, group[alive]))
        new = _runs(group[alive][by], value[by])
        alone = new & np.append(new[1:], True)
        bound[alive[by[alone]]] = size - 1
        alive = alive[by[~alone]]
    return bound


def duplicate_windows(
    group: np.ndarray, ids: np.ndarray, place: np.ndarray, windows: np.ndarray, offset: np.ndarray,
    data: np.ndarray, starts: np.ndarray, length: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that occur earlier in a context of the same group: (id, place, windows)."""
    spans = SpanHash(data)
    anchor = starts + offset
    size = windows - 1 + length
    before = _shared(group, spans, anchor, offset, False)
    after = _shared(group, spans, anchor + GRAM, size - offset - GRAM, True)
    low = np.maximum(starts, anchor - before)
    high = np.minimum(starts + windows - 1, anchor + GRAM + after - length)  # last window
    keep = high >= low
    place = (place + low - starts)[keep]
    group, ids, low, anchor = group[keep], ids[keep], low[keep], anchor[keep]
    windows = high[keep] - low + 1
    # contexts that have become equal
    value = spans(low, low + windows - 1 + length)
    by = np.lexsort((place, ids, windows, anchor - low, value, group))
    lead = _runs(group[by], value[by], (anchor - low)[by], windows[by])
    copy, by = by[~lead], by[lead]
    marks = [(ids[copy], place[copy], windows[copy])]
    # those that are left alone in their group have no partner
    group = group[by]
    new = _runs(group)
    by = by[~(new & np.append(new[1:], True))] if len(new) else by
    group, ids, place, low, windows = np.concatenate([group[:0], _ranked(group, new)]), ids[by], place[by], low[by], windows[by]
    marks += [_sorted_windows(spans, data, *part, length) for part in _portions(group, ids, place, low, windows, length)]
    return merged(*(np.concatenate(x) for x in zip(*marks)))


def _ranked(group: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Rank of the group of every member that is not alone."""
    alone = new & np.append(new[1:], True) if len(new) else new
    return (np.cumsum(new) - 1)[~alone]


def _portions(group, ids, place, low, windows, length) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole groups of similar size, about SORT_BYTES of text at a time."""
    if not len(group):
        return
    size = windows + length
    total = np.bincount(group, weights=size).astype(np.int64)
    by = np.lexsort((group, total[group]))
    group, ids, place, low, windows, size = (x[by] for x in (group, ids, place, low, windows, size))
    new = np.flatnonzero(_runs(group))
    portion = (np.cumsum(size) - size)[new] // SORT_BYTES
    cuts = new[np.flatnonzero(_runs(portion))]
    for a, b in zip(cuts, np.append(cuts[1:], len(group))):
        yield group[a:b], ids[a:b], place[a:b], low[a:b], windows[a:b]


def _sorted_windows(spans: SpanHash, data, group, ids, place, low, windows, length) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort the contexts of each group as one text and mark all but the earliest of equal windows."""
    size = windows - 1 + length
    stop = np.cumsum(size + 1)  # each context and a separator
    start = stop - size - 1
    symbols = np.ones(stop[-1], dtype=np.int64)
    symbols[ranges(start, size)] = data[ranges(low, size)].astype(np.int64) + 2
    first = np.flatnonzero(_runs(group))
    text_ends = np.append(start[first[1:]], stop[-1])
    symbols[text_ends - 1] = 0
    order = suffix_arrays(symbols, start[first], text_ends)
    owner = np.searchsorted(stop, order, side="right")
    step = order - start[owner]
    whole = step < windows[owner]  # suffixes that begin a window of their context
    owner, step = owner[whole], step[whole]
    at = low[owner] + step
    run = np.cumsum(_runs(group[owner], spans(at, at + length)))
    who, where = ids[owner], place[owner] + step
    by = np.lexsort((where, who, run))
    late = by[~_runs(run[by])]
    return who[late], where[late], np.ones(len(late), dtype=np.int64)


def compare_contexts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Duplicate windows of rows that come sorted by anchor; a group is kept until it is whole."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        columns = {c: table.column(c).to_numpy() for c in ("anchor", "id", "place", "windows", "offset")}
        data, starts, _ = flat(table.column("text").combine_chunks())
        windows, offset = columns["windows"].astype(np.int64), columns["offset"].astype(np.int64)
        group = np.cumsum(_runs(columns["anchor"]))
        ids, place, windows = duplicate_windows(group, columns["id"], columns["place"], windows, offset, data, starts, length)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(place), pa.array(windows.astype(np.int32))], names=["id", "place", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))  # sorted: the last group may go on
            if cut or (held and held[-1].column("anchor")[-1].as_py() != anchor[0]):
                held.append(batch.slice(0, cut))
                yield solve(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def _numbered(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, str, bool]:
    """``docs``, a column of numbers in the order of the ids (null last), and whether an id repeats.

    If no id repeats the number is the id. Otherwise rows with equal id and equal text share a number, being one document, and all others differ.
    """
    number, same = fresh(docs, "number"), fresh(docs, "same")
    key = F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(LAST))
    numbered = docs.withColumn(number, key)
    if not numbered.groupBy(number).count().filter("count > 1").limit(1).count():
        return numbered, number, False
    hashed = numbered.withColumn(same, F.unhex(F.sha2(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), 256)))
    distinct = hashed.select(F.col(number).alias("of"), F.col(same).alias("text_hash")).distinct()
    placed = distinct.repartitionByRange("of", "text_hash").sortWithinPartitions("of", "text_hash").withColumn("place", F.monotonically_increasing_id())
    placed = written(placed, "document-numbers")
    joined_rows = hashed.join(placed, (hashed[number] == placed["of"]) & (hashed[same] == placed["text_hash"]))
    return joined_rows.select(*[hashed[f"`{c}`"] for c in docs.columns], F.col("place").alias(number)), number, True


def duplicate_spans(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text", most: int = 20000) -> DataFrame:
    """Duplicate windows per document: (id, part, spans), spans sorted and apart, as array of (start, end) in bytes; ``id`` as numbered."""
    return _spans(*_numbered(docs, id_column, text_column), text_column, length, most)


def _spans(docs: DataFrame, number: str, repeats: bool, text_column: str, length: int, most: int = 20000) -> DataFrame:
    rows = docs.select(F.col(number).alias("id"), F.lit(0).cast("long").alias("part"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")).filter(F.octet_length("text") >= length)
    found = rows.mapInArrow(find_contexts(length), FOUND)
    found = found.selectExpr(
        "*",
        "lag(struct(context, id, place)) over (partition by anchor order by context, id, place) as last",
        "min(context) over (partition by anchor) <> max(context) over (partition by anchor) as several",
        "count(*) over (partition by anchor) as crowd",
    ).selectExpr(
        "*", "offset < 0 or coalesce(last.context = context, false) as again",
        "coalesce(offset >= 0 and last = struct(context, id, place), false) as same",
    ).filter("not same and (again or several)").selectExpr("anchor", "id", "place", "windows", "offset", "crowd", "again")
    found = written(found, "contexts")
    if repeats:  # equal rows are one document
        rows = rows.dropDuplicates(["id"])
    fetched = _texts(rows, found.filter(f"not again and crowd <= {most}")).mapInArrow(fetch_contexts(length), "anchor long, id long, place long, windows int, offset int, text binary")
    compared = fetched.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare_contexts(length), MARKS)
    marks = found.filter("again").select("id", "place", "windows").unionByName(compared)
    crowded = found.filter(f"not again and crowd > {most}")
    if crowded.limit(1).count():
        marks = marks.unionByName(_crowded_marks(_texts(rows, crowded), length))
    marks = marks.selectExpr("id", "shiftright(place, 32) as part", "place & 4294967295L as low", f"(place & 4294967295L) + windows - 1 + {length} as high")
    # spans per slice of a document first, so that no list is longer than the document is
    return written(marks.groupBy("id", "part").agg(F.expr("array_sort(collect_set(struct(low, high)))").alias("spans")), "spans")


def _texts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(id, part, text, wanted): the rows with their contexts in ``found``."""
    wanted = found.groupBy("id", F.shiftright("place", 32).alias("part")).agg(F.collect_list(F.struct("anchor", "place", "windows", "offset")).alias("wanted"))
    return rows.join(written(wanted, "wanted"), ["id", "part"]).select("id", "part", "text", "wanted")


def _crowded_marks(texts: DataFrame, length: int) -> DataFrame:
    """Duplicate windows among the wanted contexts of ``texts``, without their bytes."""
    rows = written(texts.mapInArrow(fetch_windows(length), f"window long, {MARKS}"), "windows")
    single = rows.filter("window is not null")
    first = single.groupBy("window").agg(F.min(F.struct("id", "place")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("window", "first")
    # written, so that the join is of two plain shuffles, which skew handling splits
    late = single.join(written(first, "windows"), "window").filter("struct(id, place) > first").select("id", "place", "windows")
    late = late.repartition("id", F.shiftright("place", 32)).sortWithinPartitions("id", "place").mapInArrow(merge_marks, MARKS)
    return rows.filter("window is null").select("id", "place", "windows").unionByName(late)


def cut_spans(schema: pa.Schema, text: int, digest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Remove the spans in the last column from the text in column ``text`` (by position)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = batch.column(text).cast(pa.binary())
            spans = batch.column(batch.num_columns - 1)
            sizes, removed, counts, kept = [], [], [], []
            for value, cuts in zip(body, spans):
                value, cuts = value.as_py(), cuts.as_py()
                pieces, at, gone, n, stop = [], 0, 0, 0, -1
                for cut in cuts or ():
                    low, high = cut["low"], cut["high"]
                    if low > stop:  # a new run of removed bytes
                        n += 1
                        pieces.append(value[at:low])
                        gone += high - low
                        at = stop = high
                    elif high > stop:
                        gone += high - stop
                        at = stop = high
                pieces.append((value or b"")[at:])
                rest = b"".join(pieces)
                sizes.append(len(value or b""))
                removed.append(gone)
                counts.append(n)
                kept.append(hashlib.sha256(rest).hexdigest() if digest else None if value is None else rest.decode("utf-8", "ignore"))
            columns = list(batch.columns[:-1])
            if digest:
                columns[text] = pa.array(kept, type=pa.string())
            else:
                columns[text] = pa.array(kept, type=schema.field(text).type)
            columns += [pa.array(sizes, type=pa.int64()), pa.array(removed, type=pa.int64()), pa.array(counts, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def digests(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes."""
    named = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    numbered, number, repeats = _numbered(named, "doc_id", "text")
    spans = _spans(numbered, number, repeats, "text", length)
    rows = numbered.join(spans, numbered[number] == spans["id"], "left").select("doc_id", "text", "spans")
    cut = rows.mapInArrow(cut_spans(pa.schema([]), 1, True), "doc_id long, kept_sha256 string, n_bytes long, n_removed long, n_spans long")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_duplicates(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with duplicate bytes cut from the text; a document that loses its whole text goes.

    A character of which only some bytes are removed goes as a whole. Columns other than the text stay as they are.
    """
    numbered, number, repeats = _numbered(docs, id_column, text_column)
    cuts = fresh(docs, "spans")
    spans = _spans(numbered, number, repeats, text_column, length).select(F.col("id").alias(number), F.col("spans").alias(cuts))
    rows = numbered.join(spans, number, "left").select(*[F.col(f"`{c}`") for c in docs.columns], cuts)
    at = docs.columns.index(text_column)
    sizes = [fresh(docs, n) for n in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.LongType()) for n in sizes]])
    whole = rows.mapInArrow(cut_spans(pa.schema([(f.name, pa.string()) for f in docs.schema.fields]), at, False), schema)
    return whole.filter(f"not (`{sizes[1]}` > 0 and `{sizes[1]}` = `{sizes[0]}`)").select(*[F.col(f"`{c}`") for c in docs.columns])
