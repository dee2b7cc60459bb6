"""Training matrix with shifted windows, training, and reuse of saved feature sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..models import boosting, evaluation, storage, training
from ..operators import cleaning as cl
from ..operators import daily as d
from ..operators import fleet
from ..operators import lookback as lb
from ..operators import reshape, sampling
from ..session import measured, written
from .daily import complete_days, matrix_columns, matrix_from_days, safe_name

FAULT_OFFSETS = tuple(range(8))
OK_OFFSETS = (0,)


def offset_days(
    df: DataFrame, offsets: Sequence[int], time_range: int = 7, spec: d.DailySpec = d.EVERYTHING,
    devices: DataFrame | None = None,
) -> DataFrame:
    """Gap-filled day rows for every (device, offset), in one pass over the readings.

    The windows of all offsets share their daily aggregates. Only the oldest day of a window
    differs (a reading exactly at its midnight is outside), so each day is aggregated twice:
    part 0 with all readings, part 1 without those at midnight.
    """
    rows = lb.with_time(cl.standard_rows(df))
    if devices is not None:
        rows = fleet.devices_in(rows, devices)
    profile = measured(
        cl.device_profile(cl.repair_sensors(rows), F.max(lb.day_of()).alias("last_seen"))
    )
    kept = profile.filter(F.size("reasons") == 0).select("sn", "last_seen")
    first, last = min(offsets), max(offsets)
    span = kept.select(
        "sn",
        F.date_sub("last_seen", last - 1 + time_range).alias("_from"),
        F.date_sub("last_seen", first - 1).alias("_until"),
    )
    inside = rows.join(span, "sn").filter(
        (lb.day_of() >= F.col("_from")) & (lb.day_of() < F.col("_until"))
    )
    clean = d.pack_by_hour(cl.repair_sensors(cl.dedupe_rows(inside.drop("_from", "_until"))))
    midnight = F.col("createtime") == F.date_trunc("day", F.col("createtime"))
    parts = F.when(midnight, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    daily = d.daily_aggregates(clean.withColumn("day_part", F.explode(parts)), spec, ["day_part"])

    wanted = F.explode(F.array(*[F.lit(int(o)) for o in offsets])).alias("out_days")
    shifted = kept.select("sn", "last_seen", wanted)
    windows = shifted.withColumn(
        "last_date", lb.cutoff(F.col("last_seen"), F.col("out_days"))
    ).withColumn("start_date", F.date_sub("last_date", time_range))
    spine = lb.date_spine(windows, ("sn", "out_days")).withColumn(
        "day_part", F.when(F.col("day_idx") == 0, 1).otherwise(0)
    )
    joined = spine.join(daily, ["sn", "date", "day_part"], "left").drop("day_part")
    return complete_days(joined, spec, ("sn", "out_days"))


def offset_matrix(
    df: DataFrame, offsets: Sequence[int], time_range: int = 7, spec: d.DailySpec = d.EVERYTHING,
    devices: DataFrame | None = None, features: Sequence[str] | None = None,
) -> DataFrame:
    """(sn, out_days, features): one row per device and offset."""
    columns = [
        c for c in matrix_columns(time_range, spec.thresholds)
        if features is None or safe_name(c[0]) in features
    ]
    days = offset_days(df, offsets, time_range, spec, devices)
    return matrix_from_days(days, columns, ("sn", "out_days"))


def offset_augmentation(
    ok: DataFrame, fault: DataFrame, labels: DataFrame, fault_offsets: Sequence[int] = FAULT_OFFSETS,
    ok_out_days: int = 0, time_range: int = 7, spec: d.DailySpec = d.EVERYTHING,
    features: Sequence[str] | None = None, duplicate_ok: bool = False, ok_label: int = 0,
) -> DataFrame:
    """Labelled rows (sn, out_days, copy, features, label).

    Faulty devices contribute one row per offset and take their class from ``labels``. Healthy
    devices contribute their one window; ``duplicate_ok`` repeats it for the second offset.
    """
    fault_rows = fleet.label_join(
        offset_matrix(fault, fault_offsets, time_range, spec, features=features), labels
    ).withColumn("copy", F.lit(0))
    ok_rows = offset_matrix(ok, [ok_out_days], time_range, spec, features=features)
    copies = F.array(F.lit(0), F.lit(1)) if duplicate_ok else F.array(F.lit(0))
    ok_rows = ok_rows.withColumn("error_type", F.lit(ok_label)).withColumn("copy", F.explode(copies))
    return fleet.error_type_as_label(fault_rows.unionByName(ok_rows))


def training_matrix(
    ok: DataFrame, fault: DataFrame, labels: DataFrame, test_size: float = 0.01, seed: int = 42,
    time_range: int = 7, fault_offsets: Sequence[int] = FAULT_OFFSETS, spec: d.DailySpec = d.EVERYTHING,
    features: Sequence[str] | None = None, duplicate_ok: bool = False, materialize: bool = True,
    ok_label: int = 0, ok_out_days: int = 0,
) -> DataFrame:
    """Augmented rows with the model code and a stratified ``split`` column.

    The matrix is written with its split: the wide rows are dealt out and sorted for the split once, however often split, fit and evaluation reread them.
    """
    rows = offset_augmentation(
        ok, fault, labels, fault_offsets, ok_out_days, time_range, spec, features, duplicate_ok, ok_label,
    ).withColumn("inverter_type_list", fn.device_type_code())
    if materialize:
        rows = written(rows, "training-matrix")
    split = sampling.stratified_split(rows, "label", ["sn", "out_days", "copy"], test_size, seed)
    return written(split, "training-split") if materialize else split


def feature_columns(df: DataFrame) -> list[str]:
    """Model input: everything but keys, label and split."""
    return [c for c in df.columns if c not in ("sn", "out_days", "copy", "label", "split", "fold")]


def train(
    spark: SparkSession, matrix: DataFrame, root: str, stamp: str, name: str = training.BOOSTED,
    out_days: int = 7, time_range: int = 7, classes: Sequence[int] = (0, 1, 2), seed: int = 42, rounds: int = boosting.MULTICLASS.rounds,
) -> tuple[str, DataFrame]:
    """Fit on the train rows, save the version, return (path, confusion matrix of the test rows)."""
    features = feature_columns(matrix)
    model, predicted = training.evaluate_model(
        name, matrix.filter(F.col("split") == "train"), matrix.filter(F.col("split") == "test"),
        features, seed, rounds,
    )
    path = storage.model_path(root, name, out_days, time_range, stamp)
    storage.save_model(spark, model, path, features, stamp)
    return path, evaluation.confusion_matrix(predicted.select("label", "prediction"), classes)


def split_from_saved(
    ok: DataFrame, fault: DataFrame, extra: DataFrame, test_size: float, seed: int,
    ok_label: int = 0, fault_label: int = 1, extra_rows: int = 4, order: Sequence[str] = ("sn",),
) -> tuple[DataFrame, DataFrame]:
    """(labelled rows with ``split``, unused extra rows) from saved feature sets.

    The first ``extra_rows`` of the extra faults join the train rows only.
    """
    columns = reshape.common_columns(ok, fault, extra)
    head, rest = sampling.head_and_rest(extra.select(*columns), order, extra_rows)
    both = reshape.union_rows(
        fleet.attach_label(ok.select(*columns), ok_label),
        fleet.attach_label(fault.select(*columns), fault_label),
    )
    split = sampling.stratified_split(both, "label", ["sn", "label"], test_size, seed)
    added = fleet.attach_label(head, fault_label).withColumn("split", F.lit("train"))
    return split.unionByName(added), rest
