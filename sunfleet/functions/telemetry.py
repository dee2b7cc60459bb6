"""Scalar functions of the telemetry domain, built from Spark expressions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

# Device model prefix to model code.
DEVICE_TYPE_CODES = {
    "TP10KB": 0.0,
    "TP12KB": 1.0,
    "TP15KB": 2.0,
    "TP17KB": 3.0,
    "TP20KB": 4.0,
    "TP25KB": 5.0,
    "TP30KB": 6.0,
    "TP33KB": 7.0,
    "TP36KB": 8.0,
    "TP40KB": 9.0,
}

def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def zero_above(column: str, limit: float = text.SENSOR_LIMIT) -> Column:
    """Sentinel readings above ``limit`` count as 0."""
    return F.expr(text.zero_above(column, limit))


def unwrap_reactive(column: str) -> Column:
    """Undo the 24-bit wrap of a small negative reactive power."""
    return F.expr(text.unwrap_reactive(column))


def unwrap_power_factor(column: str) -> Column:
    """Undo the 16-bit wrap of a negative power factor (stored in thousandths)."""
    return F.expr(text.unwrap_power_factor(column))


def parse_time(column: str, formats: Iterable[str] = text.TIME_FORMATS) -> Column:
    """Text to timestamp by the first format that fits; NULL when none does."""
    return F.expr(text.parse_time(column, formats))


def error_status(column: str = "errorcode", healthy: Iterable[str] = ("0",)) -> Column:
    """True for a fault code, false for a healthy one, NULL for a missing code."""
    return F.expr(text.error_status(column, healthy))


def in_hours(time: str, first: int, end: int) -> Column:
    """Hour of day in ``[first, end)``."""
    return F.expr(text.in_hours(time, first, end))


def ac_connected(column: str = "switchstatus") -> Column:
    return F.expr(text.ac_connected(column))


def model_prefix(sn: str = "sn") -> Column:
    return F.expr(text.model_prefix(sn))


def rated_current(sn: str = "sn") -> Column:
    """Rated phase current in ampere from the kW digits of the device id; NULL if not a number."""
    return F.expr(text.rated_current(sn))


def device_type_code(sn: str = "sn", codes: dict[str, float] | None = None) -> Column:
    """Model code of the device; NULL for an unknown model."""
    pairs = [F.lit(x) for item in (codes or DEVICE_TYPE_CODES).items() for x in item]
    return F.try_element_at(F.create_map(*pairs), model_prefix(sn))


def month_key(sn: Column | str, time: Column | str) -> Column:
    """``<sn>_<yyyymm>``."""
    return F.concat_ws("_", _col(sn), F.date_format(_col(time), "yyyyMM"))


def phase_mean(columns: Iterable[str]) -> Column:
    return F.expr(text.phase_mean(columns))


def phase_variance(columns: Iterable[str]) -> Column:
    """Population variance across columns of one row."""
    return F.expr(text.phase_variance(columns))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient; 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def seeded_key(columns: Iterable[Column | str], seed: int) -> Column:
    """Uniform 32-digit hex key of a row identity; the same on every run and every partitioning."""
    return F.md5(F.concat_ws(":", *[_col(c).cast("string") for c in columns], F.lit(str(seed))))


def cap_at(required: Column | str, available: Column | str) -> Column:
    return F.least(_col(required), _col(available))


def trailing_month(run_date: Column | str) -> tuple[Column, Column]:
    """(start, end) as ``yyyyMMdd``: the month that ends the day before ``run_date``."""
    end = F.date_sub(_col(run_date), 1)
    return F.date_format(F.add_months(end, -1), "yyyyMMdd"), F.date_format(end, "yyyyMMdd")


def is_infinite(column: Column | str) -> Column:
    return F.abs(_col(column)) == F.lit(float("inf"))


def is_finite(column: Column | str) -> Column:
    c = _col(column)
    return c.isNotNull() & ~F.isnan(c) & ~is_infinite(c)
