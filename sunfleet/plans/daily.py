"""Daily features of a look-back window, as day rows and as one wide row per device."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import changes as ch
from ..operators import daily as d
from ..operators import lookback as lb
from ..operators.reshape import pivot_days
from ..schema import PHASES, STRINGS
from .cleaning import clean_windows

CHANGED = {
    "vpv": [f"vpv{i}_{m}" for m in ("mean", "variance") for i in STRINGS],
    "vac": [f"vac{i}_{m}" for m in ("mean", "variance") for i in PHASES],
    "temperature": ["temperature_mean"],
    "energy": ["eday"],
}


def complete_days(
    joined: DataFrame, spec: d.DailySpec = d.EVERYTHING, keys: Sequence[str] = ("sn",)
) -> DataFrame:
    """Spine days with daily values to gap-filled day rows with the derived columns.

    The fill runs before every derived value, so a gap day borrows the next day's readings.
    """
    keys = list(keys)
    values = [c for c in joined.columns if c not in (*keys, "date", "day_idx")]
    days = ch.backfill_then_zero(joined, values, keys)
    if "energy" in spec.families:
        days = ch.midday_energy(days)
    if "temperature" in spec.families and "power" in spec.families:
        days = ch.temperature_per_power(days)
    changed = [c for f, cols in CHANGED.items() if f in spec.families for c in cols]
    if changed:
        days = ch.day_over_day_change(days, changed, keys)
    if "vpv" in spec.families:
        days = ch.string_noise_gate(ch.string_idle_flags(days, spec.thresholds.vpv_noise, keys))
    return days


def windowed_rows(
    df: DataFrame, out_days: int, time_range: int, visible_date: dt.date | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean readings inside the day windows, windows of kept devices, dropped devices)."""
    return clean_windows(
        df,
        F.max(lb.day_of()).alias("last_seen"),
        lambda seen: lb.day_windows(seen, out_days, time_range, visible_date),
        lb.rows_in_day_window,
    )


def window_days(
    df: DataFrame, out_days: int = 0, time_range: int = 7, visible_date: dt.date | None = None,
    spec: d.DailySpec = d.EVERYTHING,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(``time_range`` gap-filled day rows per kept device, windows, dropped devices)."""
    clean, windows, dropped = windowed_rows(df, out_days, time_range, visible_date)
    daily = d.daily_aggregates(d.pack_by_hour(clean), spec)
    return complete_days(ch.spine_join(lb.date_spine(windows), daily), spec), windows, dropped


def daily_feature_days(
    df: DataFrame, out_days: int = 0, time_range: int = 7, visible_date: dt.date | None = None,
    spec: d.DailySpec = d.EVERYTHING,
) -> DataFrame:
    return window_days(df, out_days, time_range, visible_date, spec)[0]


def matrix_columns(time_range: int = 7, t: d.Thresholds = d.DEFAULTS, draft: bool = False):
    """(matrix name, day-row column, day) in the fixed order of the feature matrix.

    Day 0 is the oldest day; change features start at day 1.
    """
    all_days, later = range(time_range), range(1, time_range)
    blocks: list[tuple[str, str, range]] = []
    for metric in ("mean", "variance"):
        blocks += [(f"vpv{i}_{metric}", f"vpv{i}_{metric}_change", later) for i in STRINGS]
    for metric in ("mean", "variance"):
        blocks += [(f"vac{i}_{metric}", f"vac{i}_{metric}_change", later) for i in PHASES]
    blocks += [(f"ipv{i}_peaks", f"ipv{i}_peaks", all_days) for i in STRINGS]
    blocks += [(f"iac{i}_peaks", f"iac{i}_peaks", all_days) for i in PHASES]
    for name, numbers, amplitudes, kind in (
        ("vpv", STRINGS, t.vpv_spikes, "spikes"),
        ("vpv", STRINGS, t.vpv_sags, "sags"),
        ("vac", PHASES, t.vac_spikes, "spikes"),
        ("vac", PHASES, t.vac_sags, "sags"),
    ):
        blocks += [
            (f"{name}{i}_{a}_{kind}", f"{name}{i}_{d.tag(a)}_{kind}", all_days)
            for i in numbers
            for a in amplitudes
        ]
    if draft:
        blocks.append(("vac_horizontal_variance", "vac_horizontal_variance", all_days))
    blocks.append(("temperature", "temperature_mean", all_days))
    blocks.append(("temperature_diff", "temperature_mean_change", later))
    if draft:
        blocks.append(("temperature_vs_power", "temperature_vs_power", all_days))
    blocks.append(("eday", "eday_change", later))
    blocks += [(c, c, all_days) for c in ("error_occur", "error_rate", "on_rate")]
    return [(f"{name}_day_{j}", column, j) for name, column, days in blocks for j in days]


def feature_names(time_range: int = 7, t: d.Thresholds = d.DEFAULTS) -> list[str]:
    return [name for name, _, _ in matrix_columns(time_range, t)]


def safe_name(name: str) -> str:
    """Name without dots, for use inside Spark expressions."""
    return name.replace(".", "_")


def matrix_from_days(
    days: DataFrame, columns: list[tuple[str, str, int]], keys: Sequence[str] = ("sn",),
    dotted: bool = False,
) -> DataFrame:
    """Day rows to one row per device; names carry dots only on request (export)."""
    cells = columns if dotted else [(safe_name(name), column, j) for name, column, j in columns]
    return pivot_days(days, cells, keys)


def daily_features(
    df: DataFrame,
    out_days: int = 0,
    time_range: int = 7,
    visible_date: dt.date | None = None,
    thresholds: d.Thresholds = d.DEFAULTS,
    dotted: bool = False,
) -> DataFrame:
    """The feature matrix: one row per kept device, 631 features for a 7-day window."""
    days = daily_feature_days(
        df, out_days, time_range, visible_date, d.DailySpec(thresholds=thresholds)
    )
    return matrix_from_days(days, matrix_columns(time_range, thresholds), dotted=dotted)


def draft_spec(ratios=None, thresholds: d.Thresholds = d.DRAFT) -> d.DailySpec:
    return d.DailySpec((*d.FAMILIES, *d.DRAFT_FAMILIES), thresholds, ratios or {})


def daily_features_ext(
    df: DataFrame, out_days: int = 0, time_range: int = 7, ratios=None,
    thresholds: d.Thresholds = d.DRAFT,
) -> DataFrame:
    """Feature matrix with phase imbalance, temperature per power, idle flags and ratio means."""
    spec = draft_spec(ratios, thresholds)
    days = daily_feature_days(df, out_days, time_range, None, spec)
    columns = matrix_columns(time_range, thresholds, draft=True)
    columns += [(f"vpv_idle_{i}", f"vpv_idle_{i}", 0) for i in STRINGS]
    columns += [(f"{name}_day_{j}", name, j) for name in spec.ratios for j in range(time_range)]
    return matrix_from_days(days, columns)
