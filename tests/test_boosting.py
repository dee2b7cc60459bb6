"""Boosted trees against a plain numpy booster, joint folds against single fits, stored trees, and the log of versions."""

import tracemalloc
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sunfleet.models import boosting, evaluation, scoring, storage, training
from sunfleet.models.boosting import UNIT, Params
from validation import queries_models, registry

NAMES = ["a", "b", "c", "day 0.5", "e"]
SMALL = Params(classes=3, rounds=4, max_depth=3, min_child_weight=1.0, gamma=0.1, reg_alpha=0.3, reg_lambda=1.0, bins=16)


def table(n=240, classes=3, seed=0):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(0, 3, n), draw.integers(0, 9, n), draw.normal(0, 1, n) * 1e6, np.round(draw.uniform(-1, 1, n), 1), np.zeros(n)])
    label = ((x[:, 0] > 1).astype(int) + (x[:, 1] > 4) * (x[:, 3] > 0)) % classes
    label = np.where(draw.random(n) < 0.1, draw.integers(0, classes, n), label)
    return x, label


def frame(spark, x, label, parts=3):
    rows = [(f"s{k}", int(y), *map(float, values)) for k, (values, y) in enumerate(zip(x, label, strict=True))]
    return spark.createDataFrame(rows, ["sn", "label", *NAMES]).repartition(parts)


def brute_trees(keys, codes, label, weights, edges, params, rounds):
    """(round, output, node, feature, border, value) of all nodes, every cut tried one by one."""
    n, outputs = len(label), params.outputs
    margin, out = np.zeros((n, outputs)), []
    for turn in range(rounds):
        taken = boosting.mixed(keys, params.seed * 1_000_003 + turn) < np.uint64(int(params.subsample * 2**64 - 1)) if params.subsample < 1 else np.ones(n, bool)
        if outputs == 1:
            p = 1 / (1 + np.exp(-margin))
            g, h = p - (label == 1)[:, None], np.maximum(p * (1 - p), 1e-16)
        else:
            p = np.exp(margin - margin.max(axis=1)[:, None])
            p = p / p.sum(axis=1)[:, None]
            g, h = p - np.eye(outputs)[label], np.maximum(2 * p * (1 - p), 1e-16)
        g, h = (np.rint(v * weights[label][:, None] * UNIT) for v in (g, h))
        step = np.zeros_like(margin)
        for k in range(outputs):
            allowed = boosting.drawn_features(codes.shape[1], params, turn, 0, k)
            part = lambda rows: (int(g[rows, k].sum()), int(h[rows, k].sum()))  # noqa: B023, E731
            fit = lambda a, b: max(abs(a / UNIT) - params.reg_alpha, 0) ** 2 / (b / UNIT + params.reg_lambda)
            queue = [(0, np.ones(n, bool), 0)]
            while queue:
                node, rows, depth = queue.pop()
                total = part(rows & taken)
                best = (0, None)
                if depth < params.max_depth:
                    for f in allowed:
                        for border in range(params.bins - 1):
                            left = rows & (codes[:, f] <= border)
                            a, b = part(left & taken), part(rows & ~left & taken)
                            if min(a[1], b[1]) / UNIT < params.min_child_weight:
                                continue
                            gain = fit(*a) + fit(*b) - fit(*total)
                            if gain > 1e-6 and gain >= params.gamma and gain > best[0] + 1e-12:
                                best = (gain, f, border, left)
                value = -np.sign(total[0]) * max(abs(total[0] / UNIT) - params.reg_alpha, 0) / (total[1] / UNIT + params.reg_lambda) * params.learning_rate
                if best[1] is None:
                    out.append((turn, k, node, -1, None, round(value, 10)))
                    step[rows, k] = value
                else:
                    _, f, border, left = best
                    out.append((turn, k, node, int(f), boosting.border_value(int(edges[f][border])), round(value, 10)))
                    queue += [(2 * node + 1, left, depth + 1), (2 * node + 2, rows & ~left, depth + 1)]
        margin += step
    return sorted(out), margin


@pytest.mark.parametrize(("seed", "classes", "flush"), [(1, 3, 20), (2, 3, 2), (3, 2, 3), (4, 2, 20)])
def test_trees_equal_brute_force(spark, monkeypatch, seed, classes, flush):
    monkeypatch.setattr(boosting, "FLUSH", flush)
    x, label = table(classes=classes, seed=seed)
    params = replace(SMALL, classes=classes, seed=seed, balanced=classes == 3, positive_weight=0.3)
    df = frame(spark, x, label)
    model = boosting.fit(df, NAMES, params, ["sn"])
    edges = boosting.borders(df, NAMES, params.bins)
    by_sn = dict(df.select("sn", F.xxhash64("sn")).collect())
    keys = np.array([by_sn[f"s{k}"] for k in range(len(x))])
    wide = boosting.ordered_code(x)
    codes = np.column_stack([np.searchsorted(edges[f], wide[:, f], side="right") for f in range(len(NAMES))])
    weights = np.array([len(label) / (classes * (label == c).sum()) for c in range(classes)]) if classes == 3 else np.array([1.0, 0.3])
    want, margin = brute_trees(keys, codes, label, weights, edges, params, params.rounds)
    got = sorted((t, k, node, NAMES.index(f) if f else -1, threshold, round(value, 10)) for t, k, node, f, threshold, value, _, _ in model.rows())
    assert got == want
    # scoring by thresholds takes the same ways as the codes
    scored = {r["sn"]: r["probability"] for r in model.transform(df).collect()}
    p = np.exp(margin - margin.max(axis=1)[:, None]) if classes == 3 else np.column_stack([np.exp(-margin), np.ones(len(x))])
    p = p / p.sum(axis=1)[:, None]
    assert np.allclose([scored[f"s{k}"] for k in range(len(x))], p, atol=1e-9)


@pytest.mark.parametrize(("seed", "classes", "flush"), [(2, 3, 2), (4, 2, 20)])
def test_one_task_grows_the_trees_of_all_tasks(spark, monkeypatch, seed, classes, flush):
    monkeypatch.setattr(boosting, "FLUSH", flush)
    x, label = table(classes=classes, seed=seed)
    params = replace(SMALL, classes=classes, rounds=3, seed=seed, subsample=0.8, colsample=0.7, balanced=classes == 3, positive_weight=0.3)
    df = frame(spark, x, label).withColumn("fold", F.pmod(F.xxhash64("sn"), F.lit(3)).cast("int"))
    grown = []
    for most in (boosting.ALONE, 0):
        monkeypatch.setattr(boosting, "ALONE", most)
        grown.append((boosting.fit(df, NAMES, params, ["sn"]).rows(), sorted(map(tuple, boosting.fold_predictions(df, NAMES, 3, params, ["sn"]).collect()))))
    assert grown[0] == grown[1] and max(r[0] for r in grown[0][0]) == 2 and len(grown[0][1]) == len(x)


def test_a_model_without_rows_has_no_cuts(spark):
    x, label = table(n=30, classes=2)
    df = frame(spark, x, label).withColumn("fold", F.lit(0))
    found = boosting.fold_predictions(df, NAMES, 2, replace(SMALL, classes=2), ["sn"]).collect()
    assert len(found) == 30 and all(r["prediction"] == 0 for r in found)


def given_matrix(spark, monkeypatch):
    """The model queries run on these rows."""
    x, label = table(seed=9)
    rows = frame(spark, x, label).toDF("sn", "label", "a", "b", "c", "d", "e")
    test = F.pmod(F.xxhash64("sn"), F.lit(5)) == 0
    rows = rows.withColumns({"out_days": F.lit(0), "copy": F.lit(0), "split": F.when(test, "test").otherwise("train")})
    monkeypatch.setattr(queries_models, "matrix", lambda spark, sf: rows)


def test_cross_validate_grows_all_published_rounds(spark, monkeypatch):
    given_matrix(spark, monkeypatch)
    grown, grow = [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda *given: grown.append(grow(*given)) or grown[-1])
    found = registry.QUERIES["cross_validate"](spark, "").collect()
    assert sorted(r["fold"] for r in found) == [-1, 0, 1, 2, 3, 4]
    ((model, _),) = grown
    assert len(model.rounds) == 300 and [len(of_round) for of_round in model.rounds] == [5] * 300
    assert all((tree.feature >= 0).any() for of_model in model.rounds[0] + model.rounds[7] for tree in of_model)


def test_train_saves_all_published_rounds(spark, monkeypatch, tmp_path):
    given_matrix(spark, monkeypatch)
    monkeypatch.setattr(queries_models, "new_path", lambda spark, label: str(tmp_path / label))
    assert sum(r["count"] for r in registry.QUERIES["train"](spark, "").collect()) > 0
    model, _, _ = storage.load_latest(spark, str(tmp_path / "models"))
    saved = model.trees.select("round", "output").distinct().collect()
    assert sorted(map(tuple, saved)) == [(turn, k) for turn in range(100) for k in range(3)]
    assert evaluation.tree_split_counts(model.trees).count() > 0


def test_trees_do_not_depend_on_partitions(spark):
    x, label = table(seed=7)
    rows = [boosting.fit(frame(spark, x, label, parts), NAMES, SMALL, ["sn"]).rows() for parts in (1, 7)]
    assert rows[0] == rows[1]


def test_more_values_than_bins():
    codes = np.arange(1000) * 3
    counts = np.ones(1000, int)
    counts[500] = 100_000  # one value holds nearly all rows
    found = boosting.choose_borders(codes, counts, 16)
    assert len(found) <= 15 and list(found) == sorted(set(found)) and codes[500] in found


def test_codes_keep_the_order_of_numbers():
    values = np.array([-np.inf, -1e300, -5.0, -1e-300, -0.0, 0.0, 1e-300, 0.1, 1.0, 1.5, 2.0, 1e300, np.inf])
    codes = boosting.ordered_code(values)
    assert (np.diff(codes) >= 0).all() and codes[4] == codes[5] == boosting.ordered_code(np.array([np.nan]))[0]
    assert boosting.border_value(int(codes[8])) == 1.0 and boosting.border_value(int(codes[2])) <= -5.0


def test_folds_grown_together_equal_single_fits(spark):
    x, label = table(classes=2, seed=5)
    params = replace(SMALL, classes=2, balanced=False, positive_weight=0.3, colsample=1.0)
    df = frame(spark, x, label).withColumn("fold", F.pmod(F.xxhash64("sn"), F.lit(3)).cast("int"))
    edges = boosting.borders(df, NAMES, params.bins)
    together = sorted(map(tuple, boosting.fold_predictions(df, NAMES, 3, params, ["sn"]).collect()))
    alone = []
    for fold in range(3):
        state = boosting.coded(df.filter(F.col("fold") != fold), NAMES, edges, ["sn"], 1)
        model, _ = boosting.grow(state, NAMES, edges, params)
        alone += [(r["fold"], r["label"], int(r["prediction"])) for r in model.transform(df.filter(F.col("fold") == fold)).collect()]
    assert together == sorted(alone)


def test_cross_validation_metrics(spark):
    x, label = table(classes=2, seed=6)
    names = ["a", "b", "c", "d", "e"]
    found = training.cross_validate(frame(spark, x, label).toDF("sn", "label", *names), names, ["sn"], 3, params=replace(SMALL, classes=2, balanced=False))
    assert sorted(r["fold"] for r in found.collect()) == [0, 1, 2] and all(r["accuracy"] > 0.6 for r in found.collect())


def test_saved_trees_score_alike_and_versions_do_not_collide(spark, tmp_path):
    x, label = table(seed=8)
    names = ["a", "b", "c", "d", "e"]
    df = frame(spark, x, label).toDF("sn", "label", *names)
    model = boosting.fit(df, names, SMALL, ["sn"])
    root = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        storage.load_latest(spark, root)
    paths = [storage.model_path(root, "boosted", 7, 7, stamp) for stamp in ("2024_01_02", "2024_01_01")]
    # two runs write at once and commit in the other order
    kinds = [storage.write_model(spark, model, path, names) for path in paths]
    assert storage.registry(spark, root).count() == 0
    numbers = [storage.commit(spark, path, path[-10:], kind) for path, kind in zip(reversed(paths), reversed(kinds), strict=True)]
    assert numbers == [1, 2]
    assert not storage._created(spark, f"{root}/log/000000000002.json", "{}")
    (tmp_path / "models" / "log" / "000000000003.json").write_text("")  # a commit that is still being written
    assert storage.registry(spark, root).count() == 2
    assert storage.commit(spark, paths[0], "2024_01_03", kinds[0]) == 4
    loaded, listed, path = storage.load_latest(spark, root)
    assert path == paths[0] and listed == names
    want = {r["sn"]: r["probability"] for r in model.transform(df).collect()}
    got = scoring.predict_proba(loaded, df, listed).collect()
    assert all(np.allclose([r["proba_label_0"], r["proba_label_1"], r["proba_label_2"]], want[r["sn"]]) for r in got)


def test_lines_of_any_number_of_tasks_are_added_up_in_bounded_memory():
    growth = boosting.Growth(SMALL, np.ones((1, 3)), 4)
    rng = np.random.default_rng(3)
    g, h = rng.integers(-9, 9, (40, SMALL.bins)), rng.integers(1, 9, (40, SMALL.bins)) << 20
    zeros, line = np.zeros(40, np.int32), np.arange(40, dtype=np.int32)
    columns = [pa.array(c) for c in (zeros, zeros, zeros, line // 4, line % 4)] + [pa.array([x.tobytes() for x in v], pa.binary()) for v in (g, h)]
    batch = pa.RecordBatch.from_arrays(columns, ["block", "model", "output", "node", "feature", "g", "h"])

    def peak(tasks):
        tracemalloc.start()
        found = pa.Table.from_batches(growth.cuts()(batch for _ in range(tasks))).to_pydict()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found, most

    few, many = peak(2), peak(400)
    assert few[0]["all_g"] == [v // 200 for v in many[0]["all_g"]] and len(few[0]["node"]) == 10
    assert many[1] < 2 * few[1]


def test_work_space_does_not_grow_with_the_batch():
    def peak(rows):
        codes, margins = [bytes(range(50))] * rows, [bytes(24)] * rows
        whole = [pa.array(np.arange(rows)), pa.array(np.zeros(rows, np.int32)), pa.array(np.full(rows, -1, np.int32)), pa.array(codes, pa.binary()), pa.array(margins, pa.binary())]
        batch = pa.RecordBatch.from_arrays(whole, ["key", "label", "fold", "codes", "margins"])
        growth = boosting.Growth(replace(SMALL, bins=64), np.ones((1, 3)), 50)
        trees = [[boosting.Tree.empty(3) for _ in range(3)]]
        tracemalloc.start()
        assert list(growth.histograms(trees, 0, 0, [[[0], [0], [0]]])(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(40_000) < 2 * peak(4_000)
