"""The trend's p-value, and wavelet peaks: small numpy helpers behind Arrow batches, where Spark cuts and shuffles the work."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import series

KEYS = series.KEYS

# executors get the helpers with the task and need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def trend_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a zero slope, from the correlation and the series length (NULL below three readings).

    Student's distribution with whole degrees of freedom is a finite series in cos(a), where sin(a) = abs(r): every term is the one before times
    cos(a)^2 and a ratio of neighbouring whole numbers. It has half as many terms as the series has readings.
    """
    n = n.cast("long")
    degrees = n - 2
    even = degrees % 2 == 0
    sine = F.least(F.abs(r), F.lit(1.0))
    square = F.greatest(F.lit(0.0), 1.0 - r * r)
    terms = F.when(even, (degrees - 2) / 2).otherwise((degrees - 3) / 2).cast("int")
    steps = F.when(terms >= 1, F.sequence(F.lit(1), F.greatest(terms, F.lit(1)))).otherwise(F.array().cast("array<int>"))

    def add(held: Column, k: Column) -> Column:
        twice = 2.0 * k
        term = held["term"] * square * F.when(even, (twice - 1) / twice).otherwise(twice / (twice + 1))
        return F.struct(term.alias("term"), (held["total"] + term).alias("total"))

    series_sum = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), add, lambda held: held["total"])
    odd = F.asin(sine) + F.when(degrees > 1, sine * F.sqrt(square) * series_sum).otherwise(0.0)
    inside = F.when(even, sine * series_sum).otherwise(odd * (2 / math.pi))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - inside))
    return F.when((n > 2) & r.isNotNull() & ~F.isnan(r), p)


def with_trend_p_value(df: DataFrame) -> DataFrame:
    p = trend_p_value(F.col("trend_rvalue"), F.col("trend_n"))
    return df.withColumn("trend_pvalue", p).drop("trend_n")


def linear_trend(
    df: DataFrame, columns: Sequence[str], tie_breakers: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    return with_trend_p_value(series.position_features(df, columns, ["trend"], tie_breakers, descending))


#: Decimals at which wavelet values are compared.
DIGITS = 6


def ricker(points: int, width: float) -> np.ndarray:
    x = np.arange(points) - (points - 1.0) / 2
    q = x * x / (width * width)
    return 2.0 / (math.sqrt(3.0 * width) * math.pi**0.25) * (1.0 - q) * np.exp(-q / 2.0)


#: Columns that are convolved at a time, and readings up to which a noise window is sorted as a whole.
PIECE, NARROW = 1024, 32


def wavelet_tables(x: np.ndarray, widths: Sequence[int], length: int) -> np.ndarray:
    """``wavelet_rows`` of several series of the same length at once: by width, series and position."""
    n = x.shape[1]
    out = np.empty((len(widths), *x.shape))
    for w, table in zip(widths, out, strict=True):
        kernel = ricker(min(10 * w, length), w)[::-1]
        start = (len(kernel) - 1) // 2
        padded = np.pad(x, ((0, 0), (len(kernel) - 1 - start, start)))
        for at in range(0, n, PIECE):
            part = padded[:, at:min(at + PIECE, n) + len(kernel) - 1]
            table[:, at:at + PIECE] = np.lib.stride_tricks.sliding_window_view(part, len(kernel), axis=1) @ kernel[::-1]
    return out


def wavelet_rows(x: np.ndarray, widths: Sequence[int], length: int) -> np.ndarray:
    """Convolution with the wavelet of every width; the support is ``min(10 * width, length)``."""
    rows = []
    for w in widths:
        kernel = ricker(min(10 * w, length), w)[::-1]
        full = np.convolve(x, kernel, mode="full")
        start = (len(kernel) - 1) // 2
        rows.append(full[start:start + len(x)])
    return np.vstack(rows)


def _row_maxima(rows: np.ndarray) -> np.ndarray:
    left = np.concatenate([rows[:, :1], rows[:, :-1]], axis=1)
    right = np.concatenate([rows[:, 1:], rows[:, -1:]], axis=1)
    return (rows > left) & (rows > right)


def ridge_ends(maxima: np.ndarray, widths: Sequence[int]) -> np.ndarray:
    """(row, column) of the narrowest maximum of every ridge line.

    Lines start at the maxima of the widest wavelet and follow the nearest maximum of the next
    narrower one within a quarter of the width; one missing width is tolerated, and an unmatched
    maximum opens a line of its own.
    """
    if max(widths) < 4:  # a quarter of the width is below one step: lines stay in their column
        columns = np.flatnonzero(maxima.any(axis=0))
        return np.column_stack([maxima[:, columns].argmax(axis=0), columns])
    lines: list[list[int]] = []  # [row, column, widths since the last match]
    done: list[list[int]] = []
    for row in range(len(widths) - 1, -1, -1):
        known = np.array([line[1] for line in lines])
        for line in lines:
            line[2] += 1
        for column in np.flatnonzero(maxima[row]):
            distance = np.abs(known - column)
            if len(known) and distance.min() <= widths[row] / 4.0:
                lines[int(distance.argmin())][:] = [row, int(column), 0]
            else:
                lines.append([row, int(column), 0])
        done += [line for line in lines if line[2] > 1]
        lines = [line for line in lines if line[2] <= 1]
    return np.array([line[:2] for line in done + lines], dtype=int).reshape(-1, 2)


class _Centred(pd.api.indexers.BaseIndexer):
    """Window of ``window_size`` positions around every row, cut at the ends."""

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        half, odd = divmod(self.window_size, 2)
        at = np.arange(num_values, dtype=np.int64)
        return np.maximum(at - half, 0), np.minimum(at + half + odd, num_values)


def noise_floor(row: np.ndarray, window: int) -> np.ndarray:
    """10th percentile around every position."""
    return pd.Series(row).rolling(_Centred(window_size=window), min_periods=1).quantile(0.1).to_numpy()


def noise_floors(rows: np.ndarray, window: int) -> np.ndarray:
    """``noise_floor`` of several rows; narrow windows of finite values are sorted all at once."""
    if window > NARROW or not np.isfinite(rows).all():
        return np.vstack([noise_floor(row, window) for row in rows])
    n = rows.shape[1]
    half, odd = divmod(window, 2)
    padded = np.pad(rows, ((0, 0), (half, half + odd - 1)), constant_values=np.inf)
    inside = np.sort(np.lib.stride_tricks.sliding_window_view(padded, window, axis=1), axis=2)
    at = np.arange(n)
    place = 0.1 * (np.minimum(at + half + odd, n) - np.maximum(at - half, 0) - 1)
    low = place.astype(np.int64)
    below = inside[:, at, low]
    above = np.where(place == low, below, inside[:, at, np.minimum(low + 1, window - 1)])
    return below + (above - below) * (place - low)


def count_wavelet_tables(
    x: np.ndarray, widths: Sequence[int], first: int, core: tuple[int, int], length: int, digits: int = DIGITS
) -> np.ndarray:
    """``count_wavelet_peaks`` of several series of the same length at once: by series and entry of ``widths``."""
    every = list(range(1, max(widths) + 1))
    tables = np.round(wavelet_tables(x, every, length), digits)
    noise = np.abs(noise_floors(tables[0], math.ceil(length / 20)))
    maxima = np.stack([_row_maxima(table) for table in tables])
    at = first + np.arange(x.shape[1])
    own = (at >= core[0]) & (at < core[1])
    out = np.zeros((len(x), len(widths)), np.int64)
    for k, w in enumerate(widths):
        if w < 4:  # lines stay in their column, see ``ridge_ends``
            ends = np.take_along_axis(tables[:w], maxima[:w].argmax(axis=0)[None], axis=0)[0]
            out[:, k] = np.sum(maxima[:w].any(axis=0) & own & (np.abs(ends) >= noise), axis=1)
            continue
        for s in range(len(x)):
            row, col = ridge_ends(maxima[:w, s], every[:w]).T
            out[s, k] = np.sum(own[col] & (np.abs(tables[row, s, col]) >= noise[s, col]))
    return out


def count_wavelet_peaks(
    x: np.ndarray, widths: Sequence[int], first: int, core: tuple[int, int], length: int, digits: int = DIGITS
) -> list[int]:
    """Peaks whose ridge ends in ``[core)``, for wavelets of width 1..w per entry of ``widths``.

    ``first`` is the series position of ``x[0]``. A peak counts if its wavelet value is at least
    the noise floor: the 10th percentile of the narrowest wavelet row in a window of a twentieth
    of the series around it. Wavelet values are rounded to ``digits`` decimals: like readings in another order then tie,
    whatever the order of a sum.
    """
    every = list(range(1, max(widths) + 1))
    rows = np.round(wavelet_rows(x, every, length), digits)
    maxima = _row_maxima(rows)
    noise = np.abs(noise_floor(rows[0], math.ceil(length / 20)))
    counts = []
    for w in widths:
        row, col = ridge_ends(maxima[:w], every[:w]).T
        inside = (first + col >= core[0]) & (first + col < core[1])
        counts.append(int(np.sum(inside & (np.abs(rows[row, col]) >= noise[col]))))
    return counts


def number_cwt_peaks(
    df: DataFrame | series.Dealt, columns: Sequence[str], widths: Sequence[int] = (1, 3),
    tie_breakers: Sequence[str] = (), chunk: int = 8192,
) -> DataFrame:
    """Wavelet peaks per (sn, kind); one column per entry of ``widths``.

    A series is cut into chunks of ``max(chunk, n / 20)`` positions with a halo that covers the
    noise window and the wavelet support, so a chunk's count equals that of the whole series.
    """
    parts = []
    for given, short in series.dealt(df, columns, tie_breakers, chunk):
        if short:
            rows = series.short_rows(given, columns, tie_breakers).select("sn", "idx", "n", F.col("n").alias("size"), F.lit(0).cast("long").alias("chunk"), "xs")
        else:
            rows = _chunks(series.indexed_rows(given, columns, tie_breakers, need=()), columns, widths, chunk)
        parts.append(_counted(rows, columns, widths))
    return reduce(DataFrame.unionByName, parts)


def _chunks(rows: DataFrame, columns: Sequence[str], widths: Sequence[int], chunk: int) -> DataFrame:
    reach = 5 * max(widths) + max(widths)
    size = F.greatest(F.lit(chunk), F.ceil(F.col("n") / 20))
    halo = F.ceil(F.col("n") / 40) + F.lit(reach + 1)
    last = F.floor((F.col("n") - 1) / size)
    low = F.greatest(F.floor((F.col("idx") - halo) / size), F.lit(0))
    high = F.least(F.floor((F.col("idx") + halo) / size), last)
    return rows.select(
        "sn", "idx", "n", size.alias("size"), F.explode(F.sequence(low, high)).alias("chunk"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("xs"),
    )


def _counted(rows: DataFrame, columns: Sequence[str], widths: Sequence[int]) -> DataFrame:
    """The peaks of every chunk, all metrics of it at once, added up per device and metric."""
    names = [f"number_cwt_peaks_{w}" for w in widths]
    kinds = list(columns)

    def per_chunk(key: tuple, table: pa.Table) -> pa.Table:
        n, step, number = (table.column(c)[0].as_py() for c in ("n", "size", "chunk"))
        idx = table.column("idx").to_numpy()
        xs = table.column("xs").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(idx), len(kinds))
        core = (number * step, min((number + 1) * step, n))
        found = count_wavelet_tables(np.ascontiguousarray(xs[np.argsort(idx, kind="stable")].T), widths, int(idx.min()), core, n)
        return pa.table({"sn": pa.array([key[0].as_py()] * len(kinds), pa.string()), "kind": pa.array(kinds, pa.string()), **{c: pa.array(found[:, k]) for k, c in enumerate(names)}})

    schema = "sn string, kind string, " + ", ".join(f"{c} bigint" for c in names)
    counted = rows.groupBy("sn", "chunk").applyInArrow(per_chunk, schema)
    return counted.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in names])
