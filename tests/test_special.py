"""Numeric helpers against known values and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunfleet.operators import special


def test_p_value_matches_numerical_integration(spark):
    def student_tail(t, df):
        grid = np.linspace(-t, t, 400001)
        density = (1 + grid**2 / df) ** (-(df + 1) / 2)
        scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        return 1 - scale * np.trapezoid(density, grid)

    cases = [(0.5, 10), (0.1, 40), (-0.8, 5), (0.02, 300)]
    df = spark.createDataFrame(cases, "r double, n long")
    out = {(row.r, row.n): row.p for row in df.withColumn("p", special.trend_p_value(F.col("r"), F.col("n"))).collect()}
    for r, n in cases:
        t = abs(r) * math.sqrt((n - 2) / (1 - r * r))
        assert out[(r, n)] == pytest.approx(student_tail(t, n - 2), abs=1e-8)


def test_p_value_without_degrees_of_freedom(spark):
    df = spark.createDataFrame([(1.0, 2), (0.0, 9), (1.0, 9)], "r double, n long")
    out = [row.p for row in df.withColumn("p", special.trend_p_value(F.col("r"), F.col("n"))).orderBy("n", "r").collect()]
    assert out[0] is None and out[1] == pytest.approx(1.0) and out[2] == pytest.approx(0.0)


def test_ricker_is_centred_and_sums_to_about_zero():
    kernel = special.ricker(101, 4.0)
    assert kernel.argmax() == 50
    assert abs(kernel.sum()) < 1e-9


def test_wavelet_peaks_of_separate_bumps():
    x = np.zeros(200)
    for centre in (40.3, 100.2, 160.4):  # off the grid: an even kernel would see two equal maxima
        x += np.exp(-0.5 * ((np.arange(200) - centre) / 2.0) ** 2)
    counts = special.count_wavelet_peaks(x, [1, 3], 0, (0, 200), 200)
    assert counts[0] >= 3 and counts[1] >= 3


def test_noise_floor_is_the_windowed_percentile():
    rng = np.random.default_rng(0)
    row = rng.normal(size=57)
    window = 9
    half, odd = divmod(window, 2)
    expected = [np.percentile(row[max(i - half, 0):min(i + half + odd, 57)], 10) for i in range(57)]
    assert np.allclose(special.noise_floor(row, window), expected)


def test_ridge_lines_of_narrow_wavelets_stay_in_their_column(monkeypatch):
    rng = np.random.default_rng(1)
    maxima = rng.random((3, 40)) < 0.2
    maxima[:, 1:] &= ~maxima[:, :-1]  # maxima are never adjacent
    fast = special.ridge_ends(maxima, [1, 2, 3])
    monkeypatch.setattr(special, "max", lambda widths: 99, raising=False)  # takes the general way
    slow = special.ridge_ends(maxima, [1, 2, 3])
    assert sorted(map(tuple, fast.tolist())) == sorted(map(tuple, slow.tolist()))


def test_wavelet_peaks_of_many_series_at_once():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 7, 45, 300, 1500):
        x = np.vstack([rng.integers(0, 40, n), rng.normal(0, 9, n), np.zeros(n)]).astype(float)
        together = special.count_wavelet_tables(x, [1, 3, 5], 0, (0, n), n)
        assert together.tolist() == [special.count_wavelet_peaks(row, [1, 3, 5], 0, (0, n), n) for row in x]
    x[1, 5] = np.nan
    assert special.noise_floors(x, 9).shape == x.shape
    assert np.allclose(special.noise_floors(x[:1], 9)[0], special.noise_floor(x[0], 9))
