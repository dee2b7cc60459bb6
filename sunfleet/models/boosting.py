"""Gradient-boosted trees for two or more classes, grown from histograms.

Feature values become bin codes once. For every level of a round one job adds up gradients and curvatures by (model, class, node, feature, bin); the sums
are split by feature over the cluster, where the best cuts of every node are found, and only a few lines per node reach the driver. Several models can
grow on the same read of the rows, each without one fold of them (cross-validation).

All sums are whole numbers (units of 2^-20), and samples depend on row keys only, so the trees do not depend on how the rows are partitioned. Rows with
codes and margins are written every ``FLUSH`` rounds; in between the tasks add the newest trees themselves. A lost executor costs at most one level.

Few rows (``ALONE``) go whole to one task per model, which grows the same trees of all rounds without a job per level.

Gradients are those of the softmax or logistic loss; gain and leaves take L1 and L2 penalties, and a cut needs ``gamma`` gain and ``min_child_weight`` on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

# executors get the helpers with the task and need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Whole units of gradients, rounds between written margins, bits of a double that a bin border may use (sign, exponent, 8 of the fraction).
UNIT, FLUSH, SHIFT = float(1 << 20), 20, 44


@dataclass(frozen=True)
class Params:
    """The three-class form; see ``BINARY`` for the other one."""

    classes: int = 3
    rounds: int = 100
    learning_rate: float = 0.08
    max_depth: int = 5
    min_child_weight: float = 5.0
    subsample: float = 0.9
    colsample: float = 0.6
    gamma: float = 1.0
    reg_alpha: float = 5.0
    reg_lambda: float = 10.0
    balanced: bool = True
    positive_weight: float = 1.0
    bins: int = 64
    seed: int = 42

    @property
    def outputs(self) -> int:
        """Trees of a round: one per class, one alone for two classes."""
        return 1 if self.classes == 2 else self.classes


# The two published settings.
MULTICLASS = Params()
BINARY = Params(
    classes=2, rounds=300, learning_rate=0.1, min_child_weight=3.0, subsample=0.8, colsample=0.7, gamma=0.0, reg_alpha=4.0, reg_lambda=8.0,
    balanced=False, positive_weight=0.3,
)


# ---- bins ----


def ordered_code(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles (NaN counts as 0), coarse to 8 bits of the fraction."""
    bits = (np.nan_to_num(values, nan=0.0, posinf=np.inf, neginf=-np.inf) + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))) >> SHIFT


def border_value(code: int) -> float:
    """The least double of a code."""
    bits = np.int64(code) << np.int64(SHIFT)
    return float((bits ^ ((bits >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))).reshape(1).view(np.float64)[0])


def choose_borders(codes: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` codes that begin a new bin: all of them, or a bin for each frequent code and even shares of the others."""
    if len(codes) <= bins:
        return codes[1:]
    frequent = counts >= counts.sum() / bins
    share = counts[~frequent].sum() / max(1, bins - 2 * frequent.sum() - 1)
    out, held, last = [], 0, False
    for code, n, alone in zip(codes, counts, frequent, strict=True):
        if held and (alone or last or held >= share) and len(out) < bins - 1:
            out.append(code)
            held = 0
        held, last = held + n, alone
    return np.array(out, np.int64)


#: Rows that a task's numpy helpers take at a time; their work space is a few times so many rows, however large the batches are.
SLICE = 2048


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column; no array is NULL and none has a NULL."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _values(features: Sequence[str]) -> F.Column:
    """All features of a row as one array, missing ones as 0."""
    return F.array(*[F.coalesce(F.nanvl(F.col(f"`{n}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for n in features]).alias("values")


def packed(df: DataFrame, features: Sequence[str], identity: Sequence[str] = (), fold: str | None = None) -> DataFrame:
    """(key, label, fold, values): what the trees need of a row. One array instead of a column per feature is read and sent to the tasks faster."""
    key = F.xxhash64(*[F.col(c).cast("string") for c in identity]) if identity else F.lit(0).cast("long")
    label = F.col("label").cast("int") if "label" in df.columns else F.lit(None).cast("int")
    return df.select(key.alias("key"), label.alias("label"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"), _values(features))


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def borders(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Bin borders per feature from exact counts of codes over all rows."""
    return packed_borders(packed(df, features), len(features), bins)


def packed_borders(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    shift = 64 - SHIFT  # a feature's number and a code in one key

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # at most as many keys as there are codes, two numbers each
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = (np.arange(width) << shift) + (1 << (shift - 1))
        for batch in slices(batches):
            found = np.unique((ordered_code(_matrix(batch.column(0), width)) + place).ravel(), return_counts=True)
            held = added_up(*(np.concatenate(x) for x in zip(held, found, strict=True)))
        for start in range(0, len(held[0]), 1 << 16):
            keys, counts = (x[start:start + (1 << 16)] for x in held)
            yield pa.RecordBatch.from_arrays(
                [pa.array((keys >> shift).astype(np.int32)), pa.array((keys & ((1 << shift) - 1)) - (1 << (shift - 1))), pa.array(counts)], ["feature", "code", "n"]
            )

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("code")
        found = choose_borders(table.column("code").to_numpy(), table.column("n").to_numpy(), bins)
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "borders": pa.array([found.tolist()], pa.list_(pa.int64()))})

    summed = rows.select("values").mapInArrow(count, "feature int, code bigint, n bigint").groupBy("feature", "code").agg(F.sum("n").alias("n"))
    # one line per feature, at most bins - 1 numbers each
    found = {r["feature"]: r["borders"] for r in summed.groupBy("feature").applyInArrow(choose, "feature int, borders array<bigint>").collect()}
    return [np.array(found.get(k, []), np.int64) for k in range(width)]


# ---- trees ----


@dataclass
class Tree:
    """A tree in heap order: children of node i are 2i + 1 and 2i + 2. ``feature`` is -1 at leaves."""

    feature: np.ndarray
    border: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n))

    def nodes(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """Node of every row after so many levels; rows stay in leaves."""
        at = np.zeros(len(codes), np.int64)
        for _ in range(levels):
            feature = self.feature[at]
            inner = feature >= 0
            right = codes[np.arange(len(codes)), np.maximum(feature, 0)] > self.border[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at


Round = list[list[Tree]]  # by model and output


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Well spread numbers of keys (the finisher of splitmix64)."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Whole units of gradient and curvature per row and output."""
    if params.classes == 2:
        p = 1 / (1 + np.exp(-margin))
        g, h = p - (label == 1)[:, None], np.maximum(p * (1 - p), 1e-16)
    else:
        p = np.exp(margin - margin.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g, h = p - (label[:, None] == np.arange(params.classes)), np.maximum(2 * p * (1 - p), 1e-16)
    return np.rint(g * weight[:, None] * UNIT), np.rint(h * weight[:, None] * UNIT)


def shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def score(g, h, params: Params):
    return shrunk(g, params.reg_alpha) ** 2 / (h + params.reg_lambda)


def best_cuts(g: np.ndarray, h: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per line of whole sums by bin: best gain (-1 without a cut), the last bin on the left, and the left sums."""
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    all_g, all_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    real = [x / UNIT for x in (left_g, left_h, all_g - left_g, all_h - left_h, all_g, all_h)]
    gain = score(real[0], real[1], params) + score(real[2], real[3], params) - score(real[4], real[5], params)
    gain = np.where((real[1] >= params.min_child_weight) & (real[3] >= params.min_child_weight), gain, -1.0)
    at = gain.argmax(axis=1)
    rows = np.arange(len(g))
    return gain[rows, at], at, left_g[rows, at], left_h[rows, at]


def drawn_features(n: int, params: Params, turn: int, model: int, output: int) -> np.ndarray:
    """The features a tree may use."""
    share = max(1, int(params.colsample * n))
    draw = np.random.default_rng([params.seed, turn, model, output])
    return np.sort(draw.permutation(n)[:share])


# ---- growth ----

#: Features are dealt out in so many blocks; each returns one line per node.
BLOCKS = 32

STATE = "key bigint, label int, fold int, codes binary, margins binary"
SUMS = "block int, model int, output int, node int, feature int, g binary, h binary"
CUTS = "model int, output int, node int, feature int, gain double, border bigint, left_g bigint, left_h bigint, all_g bigint, all_h bigint"


#: Bytes of codes and margins up to which one task per model holds the rows and grows the model's trees; more are summed by all tasks, a job per level.
ALONE = 256 << 20

TREE_PARTS = ("feature", "border", "value", "gain", "cover")

CUT_SCHEMA = pa.schema([
    *[(n, pa.int32()) for n in ("model", "output", "node", "feature")], ("gain", pa.float64()), *[(n, pa.int64()) for n in ("border", "left_g", "left_h", "all_g", "all_h")]
])


@dataclass
class Growth:
    """What the tasks need to know: settings, weights by (model, class), and the trees since the margins were written."""

    params: Params
    weights: np.ndarray
    width: int
    recent: list[Round] = field(default_factory=list)

    @property
    def models(self) -> int:
        return len(self.weights)

    def rows(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, labels, folds, codes, and margins with the newest trees, by row, model and output."""
        n = batch.num_rows
        key, label, fold = (batch.column(k).to_numpy() for k in range(3))
        codes = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, self.width)
        margins = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.float64).reshape(n, self.models, self.params.outputs).copy()
        for trees in self.recent:
            for m, of_model in enumerate(trees):
                for k, tree in enumerate(of_model):
                    margins[:, m, k] += tree.value[tree.nodes(codes, self.params.max_depth)]
        return key, label, fold, codes, margins

    def histograms(self, growing: Round, level: int, turn: int, open_nodes: list[list[list[int]]]):
        """Function of a task: sums of its rows for every node that may be cut."""
        params, bins = self.params, self.params.bins

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # by model and output, then by (feature, gradient or curvature, node and bin)
            sums: dict[tuple[int, int], np.ndarray] = {}
            drawn = {(m, k): drawn_features(self.width, params, turn, m, k) for m in range(self.models) for k in range(params.outputs)}
            for batch in slices(batches):
                key, label, fold, codes, margins = self.rows(batch)
                by_feature = np.ascontiguousarray(codes.T)
                taken = mixed(key, params.seed * 1_000_003 + turn) < np.uint64(int(params.subsample * 2**64 - 1)) if params.subsample < 1 else np.ones(len(key), bool)
                for m in range(self.models):
                    use = np.flatnonzero(taken & (fold != m))
                    weight = self.weights[m][label[use]]
                    g, h = gradients(margins[use, m, :], label[use], weight, params)
                    for k in range(params.outputs):
                        nodes = open_nodes[m][k]
                        if not nodes:
                            continue
                        place = np.full(2 ** (level + 1) - 1, -1, np.int64)
                        place[nodes] = np.arange(len(nodes))
                        at = place[growing[m][k].nodes(codes[use], level)]
                        inside = at >= 0
                        start, chosen, size = at[inside] * bins, drawn[m, k], len(nodes) * bins
                        held = sums.setdefault((m, k), np.zeros((len(chosen), 2, size)))
                        own, gradient, curvature = use[inside], np.ascontiguousarray(g[inside, k]), np.ascontiguousarray(h[inside, k])
                        for line, f in zip(held, chosen, strict=True):
                            spots = start + by_feature[f, own]
                            # whole numbers: exact in doubles as well
                            line[0] += np.bincount(spots, gradient, size)
                            line[1] += np.bincount(spots, curvature, size)
            for (m, k), held in sums.items():
                chosen, nodes = drawn[m, k], open_nodes[m][k]
                lines = held.reshape(len(chosen), 2, len(nodes), bins).transpose(1, 2, 0, 3).reshape(2, len(nodes) * len(chosen), bins).astype(np.int64)
                used = np.flatnonzero(lines[1].any(axis=1))
                feature = chosen[used % len(chosen)].astype(np.int32)
                columns = [
                    pa.array(feature % BLOCKS), pa.array(np.full(len(used), m, np.int32)), pa.array(np.full(len(used), k, np.int32)),
                    pa.array(np.array(nodes, np.int32)[used // len(chosen)]), pa.array(feature), *[pa.array([x.tobytes() for x in lines[i][used]], pa.binary()) for i in (0, 1)],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "model", "output", "node", "feature", "g", "h"])

        return add

    def cuts(self):
        """Function of the lines of some blocks of features: the best cut in them for every node. The lines of all tasks are added up as they come, so
        what is held depends on the numbers of nodes, features and bins alone."""
        params, bins = self.params, self.params.bins

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            where, sums = np.zeros((0, 4), np.int64), np.zeros((0, 2, bins), np.int64)
            for batch in slices(batches):
                new = np.column_stack([batch.column(c).to_numpy() for c in ("model", "output", "node", "feature")]).astype(np.int64)
                lines = np.stack([np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64).reshape(-1, bins) for c in ("g", "h")], axis=1)
                where, sums = np.concatenate([where, new]), np.concatenate([sums, lines])
                order = np.lexsort(where.T[::-1])
                where, sums = where[order], sums[order]
                first = np.flatnonzero(np.concatenate([[True], np.any(where[1:] != where[:-1], axis=1)]))
                where, sums = where[first], np.add.reduceat(sums, first, axis=0)
            if not len(where):
                return
            gain, border, left_g, left_h = best_cuts(sums[:, 0], sums[:, 1], params)
            model, output, node, feature = where.T
            best = np.lexsort((feature, -gain, node, output, model))
            keep = best[np.concatenate([[True], np.any([w[best][1:] != w[best][:-1] for w in (model, output, node)], axis=0)])]
            columns = (model, output, node, feature, gain, border, left_g, left_h, sums[:, 0].sum(axis=1), sums[:, 1].sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(c[keep], f.type) for f, c in zip(CUT_SCHEMA, columns, strict=True)], schema=CUT_SCHEMA)

        return find

    def moved(self):
        """Function of a task: rows with their margins brought up to date."""

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                margins = self.rows(batch)[4]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([m.tobytes() for m in margins], pa.binary())], ["key", "label", "fold", "codes", "margins"])

        return move


def _leaf(g: float, h: float, params: Params) -> float:
    return float(-shrunk(g / UNIT, params.reg_alpha) / (h / UNIT + params.reg_lambda) * params.learning_rate)


def _take(trees: Round, found: Iterable[Mapping], level: int, params: Params) -> list[list[list[int]]]:
    """Make the best cuts of a level in the trees; returns the nodes of the next level, which come in pairs."""
    open_nodes: list[list[list[int]]] = [[[] for _ in of_model] for of_model in trees]
    for c in found:
        tree, node = trees[c["model"]][c["output"]], c["node"]
        if level == 0:
            tree.value[0], tree.cover[0] = _leaf(c["all_g"], c["all_h"], params), c["all_h"] / UNIT
        if c["gain"] <= 1e-6 or c["gain"] < params.gamma:
            continue
        tree.feature[node], tree.border[node], tree.gain[node] = c["feature"], c["border"], c["gain"]
        for child, g, h in ((2 * node + 1, c["left_g"], c["left_h"]), (2 * node + 2, c["all_g"] - c["left_g"], c["all_h"] - c["left_h"])):
            tree.value[child], tree.cover[child] = _leaf(g, h, params), h / UNIT
            open_nodes[c["model"]][c["output"]].append(child)
    return open_nodes


def _grow_round(state: DataFrame, growth: Growth, turn: int) -> Round:
    """One tree per model and output, level by level."""
    params = growth.params
    trees: Round = [[Tree.empty(params.max_depth) for _ in range(params.outputs)] for _ in range(growth.models)]
    open_nodes = [[[0] for _ in range(params.outputs)] for _ in range(growth.models)]
    for level in range(params.max_depth):
        sums = state.mapInArrow(growth.histograms(trees, level, turn, open_nodes), SUMS)
        # at most one line per node and block
        lines = sums.repartition(BLOCKS, "block").mapInArrow(growth.cuts(), CUTS).collect()
        best: dict[tuple[int, int, int], T.Row] = {}
        for c in lines:
            at = (c["model"], c["output"], c["node"])
            if at not in best or (c["gain"], -c["feature"]) > (best[at]["gain"], -best[at]["feature"]):
                best[at] = c
        open_nodes = _take(trees, best.values(), level, params)
        if not any(nodes for of_model in open_nodes for nodes in of_model):
            break
    return trees


class Alone:
    """All rows of one model in one task. Trees are those of ``_grow_round``: sums are whole numbers, so a node's are its parent's without its sibling's."""

    def __init__(self, params: Params, weights: np.ndarray, model: int, key: np.ndarray, label: np.ndarray, margins: np.ndarray, codes: np.ndarray):
        self.params, self.model, self.key, self.label, self.margins = params, model, key, label, margins
        # by feature; one with a single code can not be cut
        self.weight, self.codes, self.varied = weights[label], codes, codes.min(axis=1) < codes.max(axis=1)

    def sums(self, rows: np.ndarray, slot: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """Gradients and curvatures of the rows by (feature, slot of the node, bin)."""
        bins = self.params.bins
        out, start = np.zeros((2, len(drawn), nodes * bins)), slot * bins
        for line, f in enumerate(drawn):
            spots = start + self.codes[f].take(rows)
            # whole numbers: exact in doubles as well
            out[0, line] = np.bincount(spots, g, nodes * bins)
            out[1, line] = np.bincount(spots, h, nodes * bins)
        return out.reshape(2, len(drawn), nodes, bins)

    def level(self, nodes: list[int], at: np.ndarray, use: np.ndarray, g: np.ndarray, h: np.ndarray, drawn: np.ndarray, above: tuple[dict[int, int], np.ndarray] | None) -> np.ndarray:
        """Sums by (feature, node, bin) of the open nodes; of two siblings the one with fewer rows is added up."""
        slot = np.full(max(nodes) + 1, -1, np.int64)
        slot[nodes] = np.arange(len(nodes))
        own = slot[at[use]]
        if above is None:
            return self.sums(use, own, 1, g, h, drawn)
        places, held = above
        counts = np.bincount(own[own >= 0], minlength=len(nodes)).reshape(-1, 2)
        few = counts.argmin(axis=1)
        pair, side = np.where(own >= 0, own // 2, 0), own % 2
        inside = np.flatnonzero((own >= 0) & (side == few[pair]))
        small = self.sums(use[inside], pair[inside], len(few), g[inside], h[inside], drawn)
        both = np.empty((2, len(drawn), len(few), 2, self.params.bins))
        both[:, :, np.arange(len(few)), few] = small
        parents = held[:, :, [places[(n - 1) // 2] for n in nodes[::2]]]
        both[:, :, np.arange(len(few)), 1 - few] = parents - small
        return both.reshape(2, len(drawn), len(nodes), self.params.bins)

    def tree(self, turn: int, output: int, use: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[Tree, np.ndarray]:
        """(tree, node of every row)"""
        params = self.params
        drawn = drawn_features(len(self.codes), params, turn, self.model, output)
        drawn = drawn[self.varied[drawn]] if self.varied[drawn].any() else drawn[:1]
        tree, at, nodes, above = Tree.empty(params.max_depth), np.zeros(len(self.key), np.int64), [0], None
        every = np.arange(len(at))
        for level in range(params.max_depth):
            held = self.level(nodes, at, use, g, h, drawn, above)
            found = []
            for place, node in enumerate(nodes):
                of_node = held[:, :, place]
                if not of_node[1, 0].any():
                    continue
                gain, border, left_g, left_h = best_cuts(of_node[0], of_node[1], params)
                best = int(gain.argmax())
                values = (0, 0, node, int(drawn[best]), float(gain[best]), int(border[best]), float(left_g[best]), float(left_h[best]), float(of_node[0, 0].sum()), float(of_node[1, 0].sum()))
                found.append(dict(zip(CUT_SCHEMA.names, values, strict=True)))
            above = {node: place for place, node in enumerate(nodes)}, held
            nodes = sorted(_take([[tree]], found, level, params)[0][0])
            if not nodes:
                break
            feature = tree.feature[at]
            at = np.where(feature >= 0, 2 * at + 1 + (self.codes[np.maximum(feature, 0), every] > tree.border[at]), at)
        return tree, at

    def round(self, turn: int) -> list[Tree]:
        params = self.params
        use = np.flatnonzero(mixed(self.key, params.seed * 1_000_003 + turn) < np.uint64(int(params.subsample * 2**64 - 1))) if params.subsample < 1 else np.arange(len(self.key))
        g, h = gradients(self.margins[use], self.label[use], self.weight[use], params)
        grown = [self.tree(turn, k, use, np.ascontiguousarray(g[:, k]), np.ascontiguousarray(h[:, k])) for k in range(params.outputs)]
        for k, (tree, at) in enumerate(grown):
            self.margins[:, k] += tree.value[at]
        return [tree for tree, _ in grown]


def _grow_alone(state: DataFrame, growth: Growth) -> list[Round]:
    """The trees of all rounds from few rows: one task per model grows them without a job per level."""
    params = growth.params

    def grow_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, parts = 0, []
        for batch in slices(batches):
            model = batch.column(5)[0].as_py()
            key, label, _, codes, margins = growth.rows(batch)
            parts.append((key, label, margins[:, model].copy(), codes))
        if not parts:
            return
        key, label, margins = (np.concatenate(columns) for columns in list(zip(*parts, strict=True))[:3])
        whole, at = np.empty((growth.width, len(key)), np.uint8), 0
        while parts:  # from the end; what is copied is let go
            codes = parts.pop()[3]
            at += len(codes)
            whole[:, len(key) - at:len(key) - at + len(codes)] = codes.T
        alone = Alone(params, growth.weights[model], model, key, label, margins, whole)
        for turn in range(params.rounds):
            trees = alone.round(turn)
            lines = [[getattr(t, n).tobytes() for n in TREE_PARTS] for t in trees]
            yield pa.RecordBatch.from_pydict({
                "model": pa.array([model] * len(trees), pa.int32()), "turn": pa.array([turn] * len(trees), pa.int32()), "output": pa.array(range(len(trees)), pa.int32()),
                **{n: pa.array(values, pa.binary()) for n, values in zip(TREE_PARTS, zip(*lines, strict=True), strict=True)},
            })

    numbers = F.explode(F.array(*[F.lit(m) for m in range(growth.models)])).alias("model")
    rows = state.select("*", numbers).filter("fold <> model").repartitionById(growth.models, "model")
    grown: list[Round] = [[[Tree.empty(params.max_depth) for _ in range(params.outputs)] for _ in range(growth.models)] for _ in range(params.rounds)]
    # a few numbers per node: rounds x models x outputs x nodes
    for r in rows.mapInArrow(grow_all, "model int, turn int, output int, " + ", ".join(f"{n} binary" for n in TREE_PARTS)).collect():
        kinds = (np.int32, np.int64, np.float64, np.float64, np.float64)
        grown[r["turn"]][r["model"]][r["output"]] = Tree(*[np.frombuffer(r[n], kind) for n, kind in zip(TREE_PARTS, kinds, strict=True)])
    return grown


def coded(df: DataFrame, features: Sequence[str], edges: list[np.ndarray], identity: Sequence[str], outputs: int, models: int = 1, fold: str | None = None) -> DataFrame:
    """(key, label, fold, codes, margins): rows ready to grow trees on."""
    return packed_codes(packed(df, features, identity, fold), edges, outputs, models)


def packed_codes(rows: DataFrame, edges: list[np.ndarray], outputs: int, models: int = 1) -> DataFrame:
    width = models * outputs * 8

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            wide = np.ascontiguousarray(ordered_code(_matrix(batch.column(3), len(edges))).T)
            found = np.column_stack([np.searchsorted(of_feature, line, side="right").astype(np.uint8) for of_feature, line in zip(edges, wide, strict=True)])
            columns = [batch.column(k) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([row.tobytes() for row in found], pa.binary()), pa.array([bytes(width)] * len(found), pa.binary())], ["key", "label", "fold", "codes", "margins"])

    return rows.select("key", "label", "fold", "values").mapInArrow(code, STATE)


def class_weight_table(lines: Sequence[T.Row], params: Params, models: int) -> np.ndarray:
    """Weight by (model, class) over the rows each model sees, from their number by fold and label."""
    counts = np.zeros((models, params.classes))
    for r in lines:
        for m in range(models):
            counts[m, r["label"]] += r["count"] * (r["fold"] != m)
    if params.balanced:
        present = np.maximum((counts > 0).sum(axis=1, keepdims=True), 1)
        return counts.sum(axis=1, keepdims=True) / (present * np.maximum(counts, 1))
    weights = np.ones_like(counts)
    weights[:, 1] = params.positive_weight
    return weights


@dataclass
class TreeModel:
    """Grown trees, by round, model and output, with the feature names and bin borders they refer to."""

    params: Params
    features: list[str]
    edges: list[np.ndarray]
    rounds: list[Round]

    def rows(self, model: int = 0) -> list[tuple]:
        out = []
        for turn, of_round in enumerate(self.rounds):
            for output, tree in enumerate(of_round[model]):
                for node in np.flatnonzero((tree.cover > 0) | (np.arange(len(tree.cover)) == 0)):
                    f = int(tree.feature[node])
                    threshold = border_value(int(self.edges[f][tree.border[node]])) if f >= 0 else None
                    out.append((turn, output, int(node), self.features[f] if f >= 0 else None, threshold, float(tree.value[node]), float(tree.gain[node]), float(tree.cover[node])))
        return out

    def table(self, spark: SparkSession, model: int = 0) -> DataFrame:
        """(round, output, node, feature, threshold, value, gain, cover): values below the threshold go to node 2n + 1, others to 2n + 2; leaves have no feature."""
        return spark.createDataFrame(self.rows(model), TREES)

    def transform(self, df: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
        """``df``, or the ``carried`` columns of it, with ``probability`` (array) and ``prediction``."""
        return with_probability(df, self.table(df.sparkSession), self.features, self.params.classes, carried)


TREES = "round int, output int, node int, feature string, threshold double, value double, gain double, cover double"


def with_probability(df: DataFrame, trees: DataFrame, features: Sequence[str], classes: int, carried: Sequence[str] | None = None) -> DataFrame:
    """Class probabilities by a table of trees (bounded by rounds x nodes, sent to the tasks), and the likeliest class. The tasks hand on all columns, or
    the ``carried`` ones; the features reach them as one array."""
    names, outputs = list(features), 1 if classes == 2 else classes
    place = {n: k for k, n in enumerate(names)}
    grown: dict[tuple[int, int], dict[int, tuple]] = {}
    for r in trees.collect():
        grown.setdefault((r["round"], r["output"]), {})[r["node"]] = (place[r["feature"]] if r["feature"] is not None else -1, r["threshold"], r["value"])
    packed = []
    for (_, output), nodes in sorted(grown.items()):
        n = max(nodes) + 1
        feature, threshold, value = np.full(n, -1, np.int64), np.zeros(n), np.zeros(n)
        for node, (f, t, v) in nodes.items():
            feature[node], threshold[node], value[node] = f, t if f >= 0 else 0.0, v
        packed.append((output, feature, threshold, value))
    sent = df.sparkSession.sparkContext.broadcast(packed)
    keep = [c for c in (df.columns if carried is None else carried) if c not in ("probability", "prediction")]

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch.column(len(keep)), len(names))
            margin = np.zeros((len(x), outputs))
            for output, feature, threshold, value in sent.value:
                at = np.zeros(len(x), np.int64)
                while True:
                    f = feature[at]
                    if (f < 0).all():
                        break
                    at = np.where(f >= 0, 2 * at + 1 + (x[np.arange(len(x)), np.maximum(f, 0)] >= threshold[at]), at)
                margin[:, output] += value[at]
            if classes == 2:
                p = 1 / (1 + np.exp(-margin[:, 0]))
                p = np.column_stack([1 - p, p])
            else:
                p = np.exp(margin - margin.max(axis=1, keepdims=True))
                p = p / p.sum(axis=1, keepdims=True)
            columns = batch.columns[:len(keep)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(p.tolist(), pa.list_(pa.float64())), pa.array(p.argmax(axis=1).astype(np.float64), pa.float64())], [*keep, "probability", "prediction"]
            )

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("probability", T.ArrayType(T.DoubleType())), T.StructField("prediction", T.DoubleType())])
    # names may hold dots, so columns travel by place
    given = df.select(*[
        F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(f"c{k}") if c in place and df.schema[c].dataType == T.DoubleType() else F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)
    ], _values(names))
    return given.mapInArrow(score_rows, schema)


def grow(state: DataFrame, features: Sequence[str], edges: list[np.ndarray], params: Params, models: int = 1) -> tuple[TreeModel, DataFrame]:
    """(model, rows with the final margins) from coded rows."""
    lines = state.groupBy("fold", "label").count().collect()
    growth = Growth(params, class_weight_table(lines, params, models), len(features))
    model = TreeModel(params, list(features), edges, [])
    if sum(r["count"] for r in lines) * (len(features) + 8 * models * params.outputs) <= ALONE:
        model.rounds = _grow_alone(state, growth)
        return model, state.mapInArrow(replace(growth, recent=model.rounds).moved(), STATE)
    for turn in range(params.rounds):
        trees = _grow_round(state, growth, turn)
        model.rounds.append(trees)
        growth.recent.append(trees)
        if len(growth.recent) == FLUSH or turn == params.rounds - 1:
            state = written(state.mapInArrow(growth.moved(), STATE), "margins")
            growth = replace(growth, recent=[])
    return model, state


def fit(train: DataFrame, features: Sequence[str], params: Params = MULTICLASS, identity: Sequence[str] = ("sn", "out_days", "copy")) -> TreeModel:
    """Boosted trees on rows with ``label`` in 0 .. classes - 1; ``identity`` names the columns that tell rows apart (for the samples)."""
    rows = written(packed(train, features, [c for c in identity if c in train.columns]), "packed")
    edges = packed_borders(rows, len(features), params.bins)
    state = written(packed_codes(rows, edges, params.outputs), "bin-codes")
    return grow(state, features, edges, params)[0]


def fold_predictions(df: DataFrame, features: Sequence[str], folds: int, params: Params, identity: Sequence[str], fold: str = "fold") -> DataFrame:
    """(fold, label, prediction) of every row by the model that did not see its fold; all models grow on one read of the rows."""
    rows = written(packed(df, features, identity, fold), "packed")
    edges = packed_borders(rows, len(features), params.bins)
    state = written(packed_codes(rows, edges, params.outputs, folds), "bin-codes")
    _, state = grow(state, features, edges, params, folds)
    outputs = params.outputs

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            margins = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.float64).reshape(n, folds, outputs)
            own = margins[np.arange(n), batch.column(2).to_numpy()]
            found = (own[:, 0] > 0).astype(np.int32) if outputs == 1 else own.argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array(found)], ["fold", "label", "prediction"])

    return state.mapInArrow(predict, "fold int, label int, prediction int")


def save(model: TreeModel, spark: SparkSession, path: str) -> None:
    model.table(spark).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "trees"))
    spark.createDataFrame([(model.params.classes,)], "classes int").coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "settings"))


@dataclass
class StoredTrees:
    """A model read back: its table of trees and number of classes."""

    trees: DataFrame
    features: list[str]
    classes: int

    def transform(self, df: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
        return with_probability(df, self.trees, self.features, self.classes, carried)


def load(spark: SparkSession, path: str, features: Sequence[str]) -> StoredTrees:
    classes = spark.read.parquet(os.path.join(path, "settings")).first()["classes"]
    return StoredTrees(spark.read.schema(TREES).parquet(os.path.join(path, "trees")), list(features), classes)
