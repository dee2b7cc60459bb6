"""Whole-window statistics as composed plans: long rows, and one wide row per device."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import lookback as lb
from ..operators import reshape, series, special
from ..operators.quantiles import quantile_name
from ..session import written
from .cleaning import clean_windows

KEYS = series.KEYS


def window_rows(
    df: DataFrame, days: int = 0, out_days: int = 30, newest_visible: dt.datetime | None = None,
    min_rows: int | None = None, min_days: int | None = None,
) -> DataFrame:
    """Clean readings of the look-back window, optionally only of well covered devices."""
    rows, _, _ = clean_windows(
        df,
        F.max("createtime").alias("newest"),
        lambda newest: lb.time_windows(newest, days, out_days, newest_visible),
        lb.inside_time_window,
    )
    if min_rows is not None:
        rows, _ = lb.min_rows_gate(rows, min_rows)
    if min_days is not None:
        rows, _ = lb.min_days_gate(rows, min_days)
    return rows


def all_features(
    rows: DataFrame, columns: Sequence[str], tie_breakers: Sequence[str] = (), descending: bool = False,
    interpolation: str = "linear", wavelet_peaks: bool = False,
) -> DataFrame:
    """Every statistic per (sn, kind).

    The readings of the window are written once with the columns in use. One pass in time order
    yields everything but the quantiles (and the wavelet peaks); the blocks that are joined hold
    one row per device and metric.
    """
    rows = series.dealt(rows, columns, tie_breakers)
    ordered = ["moments", *series.POSITION, *series.NEIGHBOUR]
    out = special.with_trend_p_value(
        series.series_features(rows, columns, ordered, tie_breakers, descending)
    )
    quantiles = {"median": 0.5, **{quantile_name(q): q for q in series.QUANTILES}}
    if interpolation == "linear":
        out = out.join(series.named_quantiles(rows, columns, quantiles), KEYS)
    else:
        out = out.join(series.median_feature(rows, columns), KEYS).join(
            series.quantile_features(rows, columns, interpolation=interpolation), KEYS
        )
    if wavelet_peaks:
        out = out.join(special.number_cwt_peaks(rows, columns, tie_breakers=tie_breakers), KEYS)
    return out


def widen(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per device with ``<metric>_<statistic>`` columns, all of them doubles."""
    features = [c for c in long.columns if c not in KEYS]
    return reshape.widen_vectors(reshape.feature_vectors(long, features), columns, features)


def window_statistics(
    df: DataFrame, columns: Sequence[str], days: int = 0, out_days: int = 30,
    newest_visible: dt.datetime | None = None, tie_breakers: Sequence[str] = (),
    descending: bool = False, interpolation: str = "nearest",
) -> DataFrame:
    """One wide row per device."""
    rows = window_rows(df, days, out_days, newest_visible)
    long = all_features(rows, columns, tie_breakers, descending, interpolation)
    return widen(long, columns)


def window_statistics_long(
    df: DataFrame, columns: Sequence[str], days: int = 0, out_days: int = 30,
    newest_visible: dt.datetime | None = None, min_rows: int | None = None,
    min_days: int | None = None, tie_breakers: Sequence[str] = (), wavelet_peaks: bool = True,
) -> DataFrame:
    """One row per device with imputed features, computed through the long form."""
    rows = window_rows(df, days, out_days, newest_visible, min_rows, min_days)
    long = all_features(rows, columns, tie_breakers, wavelet_peaks=wavelet_peaks)
    features = [c for c in long.columns if c not in KEYS]
    vectors = written(reshape.feature_vectors(long, features), "window-statistics")
    return reshape.widen_vectors(reshape.impute_vectors(vectors), columns, features)
