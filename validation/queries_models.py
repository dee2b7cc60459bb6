"""Training, evaluation, storage and scoring."""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import replace

from pyspark.sql import functions as F

from sunfleet.models import boosting, evaluation, scoring, storage, training
from sunfleet.operators import daily as d
from sunfleet.operators import fleet
from sunfleet.plans import scoring as score_plan
from sunfleet.plans import training as train_plan
from sunfleet.session import new_path, written
from sunfleet.sources import writers

from . import sql
from .inputs import all_labels, fault_labels, predictions, score_rows, telemetry
from .queries_cleaning import q
from .queries_daily import _OFFSET_FAMILIES, _OFFSET_NAMES
from .registry import query

SPEC = d.DailySpec(tuple(_OFFSET_FAMILIES))


@query(
    "class_weights",
    q(
        "select sn, cast(label as bigint) as label, round((count(*) over ())::double / "
        "((select count(distinct label) from all_labels) * count(*) over (partition by label)), 9) + 0.0 as weight from all_labels"
    ),
)
def class_weights(spark, sf):
    return evaluation.class_weights(all_labels(spark, sf))


_COUNTS = "select label, prediction, count(*) as c from predictions group by 1, 2"


@query(
    "classification_metrics",
    q(
        "select round(sum(hits)/sum(support), 9) + 0.0 as accuracy, round(sum(support*hits/support)/sum(support), 9) + 0.0 as weighted_recall, "
        "round(sum(support*2*hits/(support+predicted))/sum(support), 9) + 0.0 as weighted_f1 from "
        "(select l.label, sum(l.n)::double as support, any_value(h.hits)::double as hits, any_value(p.predicted)::double as predicted from "
        "(select label, count(*) as n from predictions group by 1) l "
        "left join (select label, count_if(label=prediction) as hits from predictions group by 1) h using (label) "
        "left join (select prediction as label, count(*) as predicted from predictions group by 1) p using (label) group by 1)"
    ),
)
def classification_metrics(spark, sf):
    return evaluation.classification_metrics(predictions(spark, sf))


@query(
    "confusion_matrix",
    q(
        "select cast(a as bigint) as label, cast(b as bigint) as prediction, "
        "(select count(*) from predictions where label=a and prediction=b) as count from range(3) t(a), range(3) s(b)"
    ),
)
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(predictions(spark, sf), [0, 1, 2])


_LABEL = "case when proba_label_2>=0.8::double then 2 when proba_label_1>=0.8::double then 1 else 0 end"
_SCORES = f"select *, {_LABEL} as label from score_rows"


def scores(spark, sf):
    return scoring.labelled_scores(score_rows(spark, sf), scoring.multi_threshold_label(0.80, 0.80))


@query(
    "multi_threshold_label",
    q(
        f"select sn, cast(label as bigint) as label, {sql.rnd('proba_label_0')}, {sql.rnd('proba_label_1')}, {sql.rnd('proba_label_2')} from s",
        s=_SCORES,
    ),
)
def multi_threshold_label(spark, sf):
    return scores(spark, sf).select("sn", "label", "proba_label_0", "proba_label_1", "proba_label_2")


@query("binary_label", q("select sn, cast(proba_label_1>=0.5 as bigint) as label from score_rows"))
def binary_label(spark, sf):
    return score_rows(spark, sf).select("sn", scoring.binary_label(0.5).alias("label"))


@query("split_by_label", q("select label, count(*) as devices, min(sn) as first_sn from s group by 1", s=_SCORES))
def split_by_label(spark, sf):
    """The three result tables, each reduced to its count and first device."""
    tables = scoring.split_by_label(scores(spark, sf))
    parts = [
        t.agg(F.max("label").alias("label"), F.count(F.lit(1)).alias("devices"), F.min("sn").alias("first_sn"))
        for t in tables
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), parts).filter(F.col("devices") > 0)


@query("write_by_label", q("select sn, cast(label as bigint) as label from s", s=_SCORES))
def write_by_label(spark, sf):
    path = writers.write_by_label(scores(spark, sf), new_path(spark, "scores"))
    return spark.read.parquet(path).select("sn", "label")


@query("all_flagged_check", q("select cast(bool_and(label<>0) as bigint) as all_flagged from s", s=_SCORES))
def all_flagged_check(spark, sf):
    return scoring.all_flagged_check(scores(spark, sf))


_RULE = q(
    "select sn, cast(case when error_rate_day_6>=0.5 then 2 when on_rate_day_6<1 then 1 else 0 end as bigint) as label, "
    "strftime(last_date, '%Y-%m-%d') as time from (select sn, max(case when day_idx=6 then error_rate end) as error_rate_day_6, "
    "max(case when day_idx=6 then on_rate end) as on_rate_day_6 from days group by sn) join win using (sn)",
    **sql.daily_blocks(["error", "switch"], visible="2024-01-28")[0],
)


@query("score_fleet_by_rule", _RULE)
def score_fleet_by_rule(spark, sf):
    """Fleet scoring with a rule in place of the model."""
    spec = d.DailySpec(("error", "switch"))
    names = [f"{n}_day_{j}" for n in ("error_rate", "on_rate") for j in range(7)]
    matrix, cutoffs, _ = score_plan.score_features(telemetry(spark, sf), dt.date(2024, 1, 28), 7, spec, names)
    label = F.when(F.col("error_rate_day_6") >= 0.5, 2).when(F.col("on_rate_day_6") < 1, 1).otherwise(0)
    return fleet.attach_cutoff_time(matrix.select("sn", label.alias("label")), cutoffs)


# ---- a stored table of trees, scored in both engines ----


def stored_trees() -> list[tuple]:
    """Rows of a table of trees, by a rule: three rounds, three classes, two cuts each."""
    rows = []
    for turn in range(3):
        for k in range(3):
            error, on = f"error_rate_day_{(2 * turn + k) % 7}", f"on_rate_day_{(turn + 3 * k) % 7}"
            rows += [
                (turn, k, 0, error, 0.04 * (turn + 1), 0.0), (turn, k, 1, on, 0.5 + 0.15 * k, 0.0), (turn, k, 2, None, None, 0.3 * (k + 1) - 0.2 * turn),
                (turn, k, 3, None, None, 0.25 * turn - 0.1 * k), (turn, k, 4, None, None, 0.15 * k - 0.35),
            ]
    return rows


def _stored_sql() -> str:
    text = lambda v: "null" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}::double" if isinstance(v, float) else str(v)
    values = ", ".join(f"({', '.join(text(v) for v in row)})" for row in stored_trees())
    blocks = {
        **sql.daily_blocks(["error", "switch"], visible="2024-01-28")[0],
        "trees": f"select * from (values {values}) t(round, output, node, feature, threshold, value)",
        "x": "select sn, 'error_rate_day_' || day_idx as feature, coalesce(error_rate, 0) as x from days union all "
        "select sn, 'on_rate_day_' || day_idx, coalesce(on_rate, 0) from days",
    }
    step = (
        "select {n}.sn, {n}.round, {n}.output, case when t.feature is null then {n}.node when x.x < t.threshold then 2 * {n}.node + 1 else 2 * {n}.node + 2 end as node "
        "from {n} join trees t using (round, output, node) left join x on x.sn = {n}.sn and x.feature = t.feature"
    )
    blocks |= {
        "n0": "select distinct sn, round, output, 0 as node from days, trees", "n1": step.format(n="n0"), "n2": step.format(n="n1"),
        "m": "select sn, output, sum(value) as m from n2 join trees using (round, output, node) group by 1, 2",
        "p": "select sn, output, exp(m) / sum(exp(m)) over (partition by sn) as p from m",
    }
    cells = ", ".join(sql.rnd(f"max(case when output = {k} then p end)", f"proba_label_{k}") for k in range(3))
    return q(f"select sn, {cells} from p group by sn", **blocks)


@query("score_stored_trees", _stored_sql())
def score_stored_trees(spark, sf):
    """Class probabilities of the fleet by a table of trees."""
    spec = d.DailySpec(("error", "switch"))
    names = [f"{n}_day_{j}" for n in ("error_rate", "on_rate") for j in range(7)]
    rows, _, _ = score_plan.score_features(telemetry(spark, sf), dt.date(2024, 1, 28), 7, spec, names)
    trees = spark.createDataFrame([(*row, 0.0, 1.0) for row in stored_trees()], boosting.TREES)
    return scoring.predict_proba(boosting.StoredTrees(trees, names, 3), rows, names)


# ---- models: rows-only checks -----------------------------------------------------------------

#: Rounds of the other queries; ``cross_validate`` grows the published 300 (``train`` 100). The tables here have few devices, so penalties are small.
ROUNDS = 6
LIGHT = {"min_child_weight": 1.0, "reg_alpha": 0.0, "reg_lambda": 1.0, "gamma": 0.0}
THREE, TWO = replace(boosting.MULTICLASS, **LIGHT), replace(boosting.BINARY, **LIGHT)


def matrix(spark, sf):
    """Training matrix of all families."""
    t, labels = telemetry(spark, sf), fault_labels(spark, sf)
    ok, fault = t.join(labels, "sn", "left_anti"), t.join(labels, "sn", "left_semi")
    return train_plan.training_matrix(ok, fault, labels, 0.2, 42, spec=SPEC, features=_OFFSET_NAMES)


def _split(rows):
    return rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test")


@query("train_multiclass", digits=6)
def train_multiclass(spark, sf):
    """Class probabilities of the test rows."""
    train, test = _split(matrix(spark, sf))
    features = train_plan.feature_columns(train)
    model = training.train_multiclass(train, features, rounds=ROUNDS, params=THREE)
    return scoring.predict_proba(model, test, features, ids=("sn", "out_days", "label"))


def binary_matrix(spark, sf):
    return matrix(spark, sf).withColumn("label", F.when(F.col("label") > 0, 1).otherwise(0))


@query("train_binary", digits=6)
def train_binary(spark, sf):
    train, test = _split(binary_matrix(spark, sf))
    features = train_plan.feature_columns(train)
    model = training.train_binary(train, features, rounds=ROUNDS, params=TWO)
    return scoring.predict_proba(model, test, features, 2, ids=("sn", "out_days", "label"))


@query("cross_validate", digits=6)
def cross_validate(spark, sf):
    """Metrics of five folds with all published rounds, and their mean (fold -1)."""
    rows = binary_matrix(spark, sf).drop("split")
    features = train_plan.feature_columns(rows)
    per_fold = training.cross_validate(rows, features, ["sn", "out_days", "copy"], params=TWO)
    per_fold = written(per_fold, "folds")
    return per_fold.unionByName(training.mean_metrics(per_fold).withColumn("fold", F.lit(-1)))


@query("train")
def train(spark, sf):
    """Fit with all published rounds, save, and the confusion matrix of the test rows."""
    _, confusion = train_plan.train(spark, matrix(spark, sf), new_path(spark, "models"), "2024_01_31")
    return confusion


def saved(spark, sf):
    root = new_path(spark, "models")
    rows = matrix(spark, sf)
    features = train_plan.feature_columns(rows)
    model = training.train_multiclass(_split(rows)[0], features, rounds=ROUNDS, params=THREE)
    for stamp in ("2024_01_30", "2024_01_31"):
        storage.save_model(spark, model, storage.model_path(root, "boosted", 7, 7, stamp), features, stamp)
    return root, rows, features


@query("feature_importance")
def feature_importance(spark, sf):
    """Top 20 features by number of splits in the saved trees, in percent."""
    root, _, _ = saved(spark, sf)
    model, _, _ = storage.load_latest(spark, root)
    return fleet.top_n_importance(evaluation.tree_split_counts(model.trees), 20)


@query("save_model", "select * from (values (1::bigint, '2024_01_30', 'trees'), (2::bigint, '2024_01_31', 'trees')) t(version, modified, kind)")
def save_model(spark, sf):
    """The log after two versions were saved."""
    root, _, _ = saved(spark, sf)
    return storage.registry(spark, root).select("version", "modified", "kind")


@query("load_latest")
def load_latest(spark, sf):
    """The newest version scores the test rows."""
    root, rows, _ = saved(spark, sf)
    model, features, _ = storage.load_latest(spark, root)
    return scoring.predict_proba(model, _split(rows)[1], features, ids=("sn", "out_days"))


@query("predict_proba", digits=6)
def predict_proba(spark, sf):
    train_rows, _ = _split(matrix(spark, sf))
    features = train_plan.feature_columns(train_rows)
    model = training.train_multiclass(train_rows, features, rounds=ROUNDS, params=THREE)
    rows, _, _ = score_plan.score_features(telemetry(spark, sf), dt.date(2024, 1, 28), 7, SPEC, features)
    return scoring.predict_proba(model, rows, features)


@query("score_fleet", digits=6)
def score_fleet(spark, sf):
    """Scores of the whole fleet for a day, with cut-offs."""
    train_rows, _ = _split(matrix(spark, sf))
    features = train_plan.feature_columns(train_rows)
    model = training.train_multiclass(train_rows, features, rounds=ROUNDS, params=THREE)
    scored, cutoffs, _ = score_plan.score_fleet(
        telemetry(spark, sf), model, features, dt.date(2024, 1, 28), 7, SPEC
    )
    return fleet.attach_cutoff_time(scored, cutoffs)


@query("score_binary", digits=6)
def score_binary(spark, sf):
    train_rows, _ = _split(binary_matrix(spark, sf))
    features = train_plan.feature_columns(train_rows)
    model = training.train_binary(train_rows, features, rounds=ROUNDS, params=TWO)
    scored, _, _ = score_plan.score_binary(
        telemetry(spark, sf), model, features, dt.date(2024, 1, 28), 7, SPEC
    )
    return scored
