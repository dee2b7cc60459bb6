"""Gap filling and day-over-day change on the daily table (a fixed number of rows per device)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions import text
from ..schema import STRINGS

KEYS = ("sn",)


def spine_join(spine: DataFrame, daily: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All days of the spine with the daily values, NULL on days without readings."""
    return spine.join(daily, [*keys, "date"], "left")


def _newest_first(keys: Sequence[str]) -> str:
    """One order for all windows, so the rows are sorted once; later days come before a row."""
    return f"partition by {', '.join(keys)} order by date desc"


def backfill_then_zero(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """A missing value takes the next known later value of the device, else 0."""
    later = f"over ({_newest_first(keys)} rows between unbounded preceding and current row)"
    filled = {c: f"coalesce(last({c}, true) {later}, 0)" for c in columns}
    return df.selectExpr(*[f"{filled.get(c, c)} as {c}" for c in df.columns])


def _day_before(column: str, keys: Sequence[str]) -> str:
    return f"lead({column}) over ({_newest_first(keys)})"


def first_difference(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    return df.selectExpr("*", *[f"{c} - {_day_before(c, keys)} as {c}_diff" for c in columns])


def day_over_day_change(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, suffix: str = "_change"
) -> DataFrame:
    """Relative change to the day before; 0 where the day before is 0, and on the first day."""
    return df.selectExpr(
        "*", *[f"{text.relative_change(c, _day_before(c, keys))} as {c}{suffix}" for c in columns]
    )


def midday_energy(df: DataFrame) -> DataFrame:
    """Energy of the band per on-rate, from gap-filled columns; 0 where the on-rate is 0."""
    return df.selectExpr(
        "*", f"{text.ratio_or_zero('eday_end - eday_start', 'on_rate_4_eday')} as eday"
    )


def string_idle_flags(
    df: DataFrame, noise: float = 200.0, keys: Sequence[str] = KEYS, strings: Sequence[int] = STRINGS
) -> DataFrame:
    """``vpv_idle_i``: the string's daily mean stays below the noise level over the whole window."""
    w = f"over (partition by {', '.join(keys)})"
    return df.selectExpr(
        "*",
        *[
            f"if(max(vpv{i}_mean) {w} < {text.number(noise)}, 1, 0) as vpv_idle_{i}"
            for i in strings
        ],
    )


def string_at_work(df: DataFrame, strings: Sequence[int] = STRINGS) -> DataFrame:
    return df.selectExpr("*", *[f"1 - vpv_idle_{i} as vpv_at_work_{i}" for i in strings])


def string_noise_gate(df: DataFrame, strings: Sequence[int] = STRINGS) -> DataFrame:
    """Changes of an idle string are 0."""
    gated = {
        f"vpv{i}_{m}_change": f"if(vpv_idle_{i} = 1, 0.0D, vpv{i}_{m}_change)"
        for i in strings
        for m in ("mean", "variance")
    }
    return df.selectExpr(*[f"{gated.get(c, c)} as {c}" for c in df.columns])


def temperature_per_power(df: DataFrame) -> DataFrame:
    ratio = text.ratio_or_zero("temperature_mean", "activepower_mean")
    return df.selectExpr("*", f"{ratio} as temperature_vs_power")
