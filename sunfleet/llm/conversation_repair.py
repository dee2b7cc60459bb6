"""Cheapest repair of the role order of conversations, by dynamic programming with checkpoints at about every square root of their length.

A repaired conversation is empty, or an optional system turn and then pairs of user and assistant. Rows are kept (0), given another role (3), deleted (4; blank
rows and repetitions must be), and empty turns inserted (3); a truncated row that stays adds 3. Of all cheapest lists of edits the one whose initials
(D, I, K, R) come first in ASCII order is taken: walking forward, in that order the first edit is chosen that keeps the sum at the optimum (is *tight*).

The backward vectors hold the least cost to the end from each of four states (start, after system, after user, after assistant). They are stored only at
block ends; a block has about as many rows as a conversation has blocks. In the min-plus algebra a block is a 4 x 4 matrix, so

1. every block multiplies the matrices of its rows,
2. per conversation the products go backward over the blocks and give the vectors at the checkpoints,
3. every block recomputes its own vectors and walks from each state it may be entered in; per conversation these walks are chained,
4. every block emits the edits of the walk that is taken.

Blocks run in parallel and no task holds a conversation, only its blocks' summaries. Order is by turn (nulls first), then role, then a hash of the text, so
copies of a row are adjacent. First occurrences come from a minimum per (conversation, role, text), not from a window.

Nulls in role and text count as one space, a null conv_id is a conversation of its own. Roles are told by their first letter (s, u, a; others can not be kept).
Texts of any length stay in Spark. Repeated rows are repetitions. Other columns, whatever their names, are not read. Empty input gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunfleet.llm.frames import bounded_batches
from sunfleet.session import written

#: White space of ASCII.
SPACES = " \t\n\x0b\f\r"
#: Fixed values of the contract.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Least rows of a block.
SHORTEST = 64

#: States: start, after system, after user, after assistant. What an inserted or rerolled turn is, and where it leads.
STATES, ANY = range(4), 1 << 40
TURN, AFTER = "uuau", (2, 2, 3, 2)
END = (0, 2 * INSERT, INSERT, 0)
#: A row as one letter: role (s, u, a, other) and fault (0 none, 1 truncated, 2 must be deleted).
CODES = "abcdefghijkl"


def _kept(role: int, state: int) -> int | None:
    """State after keeping a row of this role, if it may stand there."""
    if role == 0:
        return 1 if state == 0 else None
    if role == 1:
        return 2 if state != 2 else None
    return 3 if role == 2 and state == 2 else None


def _choices(code: str, state: int) -> list[tuple[str, int, int]]:
    """Edits that consume a row: letter, cost and next state, in ASCII order (an insertion, I, would come after D)."""
    role, fault = divmod(CODES.index(code), 3)
    out = [("D", DELETE, state)]
    if fault < 2:
        extra = TRUNCATED * fault
        if _kept(role, state) is not None:
            out.append(("K", KEEP + extra, _kept(role, state)))
        out.append(("R", REROLE + extra, AFTER[state]))
    return out


CHOICES = {code: [_choices(code, q) for q in STATES] for code in CODES}


def step_back(code: str, after: list[int]) -> list[int]:
    """Least cost from each state before a row, with insertions, given the costs behind it."""
    out = [min(cost + after[q] for _, cost, q in CHOICES[code][state]) for state in STATES]
    for _ in range(2):  # more than two insertions in a row never pay
        out = [min(out[q], INSERT + out[AFTER[q]]) for q in STATES]
    return out


def product(codes: str) -> list[int]:
    """Least cost through a block from each state to each, row by row of the matrix."""
    columns = []
    for target in STATES:
        costs = [0 if q == target else ANY for q in STATES]
        for code in reversed(codes):
            costs = step_back(code, costs)
        columns.append(costs)
    return [columns[target][q] for q in STATES for target in STATES]


def vectors(codes: str, after: list[int]) -> list[list[int]]:
    """Costs before every row of a block, and behind the last."""
    out = [list(after)]
    for code in reversed(codes):
        out.append(step_back(code, out[-1]))
    return out[::-1]


def walk(codes: str, costs: list[list[int]], state: int) -> tuple[list[tuple[str, str, str]], int]:
    """Tight edits of a block: per row the turns inserted before it, the edit, and the role a rerolled row gets; then the state behind the block."""
    out = []
    for i, code in enumerate(codes):
        before = ""
        while True:
            delete, *others = CHOICES[code][state]
            if delete[1] + costs[i + 1][state] == costs[i][state]:
                letter, target = "D", state
                break
            if INSERT + costs[i][AFTER[state]] == costs[i][state]:
                before, state = before + TURN[state], AFTER[state]
                continue
            letter, target = next((x, q) for x, cost, q in others if cost + costs[i + 1][q] == costs[i][state])
            break
        out.append((before, letter, TURN[state] if letter == "R" else ""))
        state = target
    return out, state


def closing(state: int) -> str:
    """Turns inserted behind the last row."""
    return {0: "", 1: "ua", 2: "a", 3: ""}[state]


# ---- rows, their order and faults ----

def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of a test set: by the checksum of ``conv_id:turn`` modulo 20 dropped, emptied, without end marks, twice, or as a user's."""
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), fault.alias("fault")).filter("fault <> 0")
    return rows.selectExpr(
        "conv_id", "turn", "if(fault = 4, 'user', role) as role",
        "case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text",
        "explode(if(fault = 3, array(0, 1), array(0))) as copy",
    ).drop("copy")


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows in order with a number ``at`` (partition and place) and their faults; written, so that the numbers stay."""
    plain = rows.select(F.col("conv_id"), F.col("turn"), _text("role").alias("role"), _text("text").alias("text"))
    trimmed = F.rtrim("text", F.lit(SPACES))
    keyed = plain.select(
        "*", F.when(F.col("conv_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)).alias("same"),
        (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    # equal rows are told apart only to deal them out
    keyed = written(keyed.withColumn("tie", F.monotonically_increasing_id()), "turns")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("same"), F.col("tie")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ordered.drop("tie").withColumn("at", F.monotonically_increasing_id()), "turns-in-order")


def _coded(ordered: DataFrame) -> DataFrame:
    """(conv, turn, at, fault, code) of every row: first fault, and role and fault as one letter."""
    firsts = ordered.groupBy("conv", "same").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    rows = ordered.select("conv", "conv_id", "turn", "at", "blank", "open", F.left("role", F.lit(1)).alias("initial")).join(firsts, "at", "left")
    return rows.selectExpr(
        "conv", "conv_id", "turn", "at",
        "case when blank then 'blank' when first is null then 'duplicate' when open then 'truncated' end as fault",
        "coalesce(array_position(array('s', 'u', 'a'), initial), 0) as role",
    ).selectExpr(
        "conv", "conv_id", "turn", "at", "fault",
        f"substring('{CODES}', 3 * cast(if(role = 0, 3, role - 1) as int) + case fault when 'truncated' then 1 when 'blank' then 2 when 'duplicate' then 2 else 0 end + 1, 1) as code",
    )


def _illegal(pair: str) -> bool:
    """Whether two coded rows must not be neighbours."""
    return "suao"[CODES.index(pair[0]) // 3] + "suao"[CODES.index(pair[1]) // 3] not in ("su", "ua", "au")


# ---- the four passes over blocks ----

def _rows_out(batches: Iterator[pa.RecordBatch], make, names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [row for given in batch.to_pylist() for row in make(given)]
        columns = zip(*found, strict=True) if found else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def _summaries(batches):
    def make(r):
        codes = r["codes"]
        return [(r["conv"], r["block"], product(codes), codes[0], codes[-1], sum(_illegal(codes[k:k + 2]) for k in range(len(codes) - 1)))]

    return _rows_out(batches, make, ["conv", "block", "through", "head", "tail", "illegal"], [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.string(), pa.int64()])


def _checkpoints(batches):
    def make(r):
        after, out, illegal, ahead = list(END), [], 0, None
        for b in reversed(r["blocks"]):
            illegal += b["illegal"] + (ahead is not None and _illegal(b["tail"] + ahead))
            out.append((b["block"], after))
            after = [min(b["through"][4 * q + t] + after[t] for t in STATES) for q in STATES]
            ahead = b["head"]
        return [(r["conv"], block, vector, k == len(out) - 1, k == 0, after[0], illegal) for k, (block, vector) in enumerate(out)]

    kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
    return _rows_out(batches, make, ["conv", "block", "after", "first", "last", "cost", "illegal"], kinds)


def _exits(batches):
    def make(r):
        costs = vectors(r["codes"], r["after"])
        return [(r["conv"], r["block"], [walk(r["codes"], costs, q)[1] for q in STATES])]

    return _rows_out(batches, make, ["conv", "block", "leaves"], [pa.string(), pa.int64(), pa.list_(pa.int32())])


def _entries(batches):
    def make(r):
        state, out = 0, []
        for b in r["blocks"]:
            out.append((r["conv"], b["block"], state))
            state = b["leaves"][state]
        return out

    return _rows_out(batches, make, ["conv", "block", "state"], [pa.string(), pa.int64(), pa.int32()])


def _edits(batches):
    def make(r):
        found, state = walk(r["codes"], vectors(r["codes"], r["after"]), r["state"])
        last = len(found) - 1
        return [
            (r["conv"], at, before, letter, role, closing(state) if r["last"] and k == last else "")
            for k, (at, (before, letter, role)) in enumerate(zip(r["ats"], found, strict=True))
        ]

    names = ["conv", "at", "before", "edit", "new_role", "behind"]
    return _rows_out(batches, make, names, [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()])


def repair(rows: DataFrame, shortest: int = SHORTEST) -> tuple[DataFrame, DataFrame]:
    """Edits of every row, and one line per conversation.

    Edits: (conv, at, conv_id, turn, role, text, before, edit, new_role, behind), where ``at`` rises in the order of the rows, ``before`` and ``behind``
    name the turns inserted around a row, and ``new_role`` is the role of a rerolled row. Lines: (conv, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit).
    """
    bounded_batches(rows.sparkSession)
    ordered = _sorted(rows)
    coded = written(_coded(ordered), "turn-codes")
    faults = [F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")]
    days = coded.groupBy("conv", "turn").agg(F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), *faults)
    lines = written(days.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"), F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
    ), "conversation-lines")
    # a block is a run of places of one partition of the order; its length follows the length of the conversation
    length = f"cast(greatest({shortest}, ceil(sqrt(n))) as bigint)"
    numbered = coded.join(lines.select("conv", "n"), "conv").selectExpr(
        "conv", "at", "code", f"(at div {1 << 33}) * {1 << 33} + (at % {1 << 33}) div {length} as block"
    )
    blocks = numbered.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("at", "code"))).alias("rows")).selectExpr(
        "conv", "block", "array_join(transform(rows, x -> x.code), '') as codes", "transform(rows, x -> x.at) as ats"
    )
    blocks = written(blocks, "turn-blocks")
    through = blocks.select("conv", "block", "codes").mapInArrow(
        _summaries, "conv string, block bigint, through array<bigint>, head string, tail string, illegal bigint"
    )
    gathered = through.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "through", "head", "tail", "illegal"))).alias("blocks"))
    checkpoints = written(
        gathered.mapInArrow(_checkpoints, "conv string, block bigint, after array<bigint>, first boolean, last boolean, cost bigint, illegal bigint"), "checkpoints"
    )
    aimed = blocks.join(checkpoints.select("conv", "block", "after", "last"), ["conv", "block"])
    exits = aimed.select("conv", "block", "codes", "after").mapInArrow(_exits, "conv string, block bigint, leaves array<int>")
    chained = exits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "leaves"))).alias("blocks"))
    entries = chained.mapInArrow(_entries, "conv string, block bigint, state int")
    edits = aimed.join(entries, ["conv", "block"]).select("conv", "block", "codes", "ats", "after", "last", "state").mapInArrow(
        _edits, "conv string, at bigint, before string, edit string, new_role string, behind string"
    )
    edits = written(edits, "turn-edits")
    # letters are joined per run of 256 places first; what one conversation gathers then is its audit, which is the result
    letters = "concat(repeat('I', length(before)), edit, repeat('I', length(behind)))"
    runs = edits.groupBy("conv", F.expr("at div 256").alias("run")).agg(F.array_sort(F.collect_list(F.struct("at", F.expr(letters).alias("s")))).alias("rows"))
    runs = runs.selectExpr("conv", "run", "array_join(transform(rows, x -> x.s), '') as s")
    audits = runs.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("run", "s"))).alias("rows")).selectExpr("conv", "array_join(transform(rows, x -> x.s), '') as audit")
    costs = checkpoints.filter("first").select("conv", "cost", "illegal")
    lines = lines.drop("n").join(costs, "conv").join(audits, "conv")
    texts = ordered.select("at", "conv_id", "turn", "role", "text")
    return edits.join(texts, "at"), lines


def repaired(edits: DataFrame) -> DataFrame:
    """(conv, at, place, conv_id, turn, role, text) of the repaired turns; inserted turns are empty, without a turn number, and lie around the row they were inserted at."""
    new = "transform(filter(split({0}, ''), x -> x <> ''), x -> named_struct('turn', cast(null as bigint), 'role', if(x = 'u', 'user', 'assistant'), 'text', ''))"
    role = "case new_role when 'u' then 'user' when 'a' then 'assistant' else role end"
    own = f"filter(array(named_struct('turn', cast(turn as bigint), 'role', {role}, 'text', text)), x -> edit <> 'D')"
    turns = f"concat({new.format('before')}, {own}, {new.format('behind')})"
    return edits.selectExpr("conv", "at", "conv_id", f"posexplode({turns}) as (place, made)").selectExpr("conv", "at", "place", "conv_id", "made.*")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the turns of each conversation as they stream by in order; only the hash's state is held."""
    conv, state = None, None
    for batch in batches:
        done = []
        for c, role, text in zip(*batch.columns, strict=True):
            line = role.as_py() + b":" + text.as_py()
            if c.as_py() == conv:
                state.update(b"\n" + line)
                continue
            if state:
                done.append((conv, state.hexdigest()))
            conv, state = c.as_py(), hashlib.sha256(line)
        yield _digest_batch(done)
    yield _digest_batch([(conv, state.hexdigest())] if state else [])


def _digest_batch(done: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], ["conv", "repaired_sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): hash of ``role:text``, joined by line breaks.

    A hash runs over its text from front to back, so a conversation streams through one task; nothing of it is held there.
    """
    streamed = turns.repartition("conv").sortWithinPartitions("conv", "at", "place")
    return streamed.select("conv", F.col("role").cast("binary"), F.col("text").cast("binary")).mapInArrow(_hashes, "conv string, repaired_sha256 string")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One line for every conversation of ``conversations``, repaired on ``rows``; zeros and empty audits where it has none of them."""
    edits, lines = repair(rows)
    found = lines.join(digests(repaired(edits)), "conv", "left")
    key = F.when(F.col("conv_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    given = conversations.select(key.alias("conv"), "conv_id").groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = given.join(found.drop("conv_id"), "conv", "left").fillna(0, numbers)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", *[F.col(c).cast(T.LongType()).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
