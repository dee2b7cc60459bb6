"""Expressions of the telemetry domain as Spark SQL text over column names.

Wide tables need hundreds of expressions. Text reaches the JVM in one call per expression, where
nested column objects cost several round trips each; Catalyst sees the same tree.
"""

from __future__ import annotations

from collections.abc import Iterable

# Time formats of the readings.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")

# Sentinel limit, counter wraps and ratings of the device firmware.
SENSOR_LIMIT = 5000.0
REACTIVE_WRAP_LIMIT = 16770000.0
REACTIVE_WRAP = 16777216.0
POWER_FACTOR_WRAP = 65.536
PHASE_VOLTAGE = 220.0
SQRT3 = 1.732


def number(value: float) -> str:
    """A double literal."""
    return f"{float(value)!r}D"


def named(expressions: dict[str, str]) -> list[str]:
    return [f"{text} as `{name}`" for name, text in expressions.items()]


def zero_above(c: str, limit: float = SENSOR_LIMIT) -> str:
    return f"case when {c} > {number(limit)} then 0.0D else {c} end"


def unwrap_reactive(c: str) -> str:
    return (
        f"case when {c} > {number(REACTIVE_WRAP_LIMIT)} then abs({c} - {number(REACTIVE_WRAP)}) "
        f"else {c} end"
    )


def unwrap_power_factor(c: str) -> str:
    return f"case when {c} * {c} > 1.0D then {c} - {number(POWER_FACTOR_WRAP)} else {c} end"


def parse_time(c: str, formats: Iterable[str] = TIME_FORMATS) -> str:
    tries = ", ".join(f'try_to_timestamp({c}, "{f}")' for f in formats)
    return f"coalesce({tries})"


def error_status(c: str = "errorcode", healthy: Iterable[str] = ("0",)) -> str:
    codes = ", ".join(f"'{h}'" for h in healthy)
    return f"({c} not in ({codes}))"


def in_hours(time: str, first: int, end: int) -> str:
    return f"(hour({time}) >= {first} and hour({time}) < {end})"


def ac_connected(c: str = "switchstatus") -> str:
    return f"({c} = 1.0D)"


def model_prefix(sn: str = "sn") -> str:
    return f"substring({sn}, 1, 6)"


def rated_current(sn: str = "sn") -> str:
    return (
        f"(try_cast(substring({sn}, 3, 2) as double) * 1000.0D / {number(PHASE_VOLTAGE)} "
        f"/ {number(SQRT3)} / 3.0D)"
    )


def ratio_or_zero(numerator: str, denominator: str) -> str:
    return f"coalesce(try_divide({numerator}, {denominator}), 0.0D)"


def relative_change(current: str, previous: str) -> str:
    return ratio_or_zero(f"{current} - {previous}", previous)


def phase_mean(columns: Iterable[str]) -> str:
    columns = list(columns)
    return f"(({' + '.join(columns)}) / {number(len(columns))})"


def phase_variance(columns: Iterable[str]) -> str:
    """Population variance across columns of one row."""
    columns = list(columns)
    mean = phase_mean(columns)
    squares = " + ".join(f"({c} - {mean}) * ({c} - {mean})" for c in columns)
    return f"(({squares}) / {number(len(columns))})"


def finite(c: str) -> str:
    return f"({c} is not null and not isnan({c}) and abs({c}) <> double('infinity'))"
