"""Cleaning rules for telemetry readings and for devices that report nothing.

All reading rules are row-local projections (one pass, pushed into the scan stage). Whole-row
``distinct`` combines copies on the map side before it shuffles, so a large group of copies
costs one row per task. The device test is one aggregate per device with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..session import measured
from ..schema import CORE_COLUMNS, CORE_NUMERIC, IAC, IPV, POWER, TEXT_COLUMNS, VPV

DEVICE_PREFIX = "TP"

# Rule name -> columns that are 0 or missing in every reading of an abnormal device.
SILENT_RULES: dict[str, list[str]] = {
    "iac": IAC,
    "vpv": VPV,
    "ipv": IPV,
    "power": POWER,
    "ttotal": ["ttotal"],
    "eday": ["eday"],
}


def _replace(df: DataFrame, new: dict[str, str]) -> DataFrame:
    """All columns in order, some of them by a new expression."""
    return df.selectExpr(*[f"{new[c]} as `{c}`" if c in new else f"`{c}`" for c in df.columns])


def cast_numeric(df: DataFrame, keep: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """All columns but the text ones to double; a value that is no number becomes NULL."""
    other = {c: f"try_cast({c} as double)" for c, t in df.dtypes if c not in keep and t != "double"}
    return _replace(df, other) if other else df


def device_prefix_filter(df: DataFrame, prefix: str = DEVICE_PREFIX) -> DataFrame:
    return df.filter(F.col("sn").startswith(prefix))


def select_core(df: DataFrame) -> DataFrame:
    return df.select(*CORE_COLUMNS)


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL readings of numeric columns count as 0; text columns keep their NULLs."""
    numeric = [c for c, t in df.dtypes if t not in ("string", "timestamp", "date", "timestamp_ntz")]
    chosen = numeric if columns is None else columns
    return _replace(df, {c: f"coalesce({c}, 0.0D)" for c in chosen})


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def _starting(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def clamp_ipv(df: DataFrame) -> DataFrame:
    return _replace(df, {c: text.zero_above(c) for c in _starting(df, "ipv")})


def clamp_vpv(df: DataFrame) -> DataFrame:
    return _replace(df, {c: text.zero_above(c) for c in _starting(df, "vpv")})


def unwrap_reactive(df: DataFrame) -> DataFrame:
    return _replace(df, {"reactivepower": text.unwrap_reactive("reactivepower")})


def unwrap_powerfactor(df: DataFrame) -> DataFrame:
    return _replace(df, {"powerfactor": text.unwrap_power_factor("powerfactor")})


def standard_rows(df: DataFrame, cast: bool = True) -> DataFrame:
    """Cast, prefix filter, projection and null fill: the form in which copies are recognised."""
    return fill_zero(select_core(device_prefix_filter(cast_numeric(df) if cast else df)), CORE_NUMERIC)


def repair_sensors(df: DataFrame) -> DataFrame:
    """All sentinel and counter repairs in one projection; applied after copies are dropped."""
    clamped = [*_starting(df, "ipv"), *_starting(df, "vpv")]
    return _replace(
        df,
        {
            **{c: text.zero_above(c) for c in clamped},
            "reactivepower": text.unwrap_reactive("reactivepower"),
            "powerfactor": text.unwrap_power_factor("powerfactor"),
        },
    )


def silent_flags() -> list[Column]:
    """One boolean aggregate per rule: every reading of every listed column is 0 or missing."""
    return [
        F.expr(
            "bool_and(" + " and ".join(f"coalesce({c}, 0.0D) = 0.0D" for c in columns) + f") as silent_{rule}"
        )
        for rule, columns in SILENT_RULES.items()
    ]


def device_profile(df: DataFrame, *extra: Column) -> DataFrame:
    """One row per device: silent flags, reasons and any further aggregates.

    Copies do not change any of these, so the profile needs no distinct before it.
    """
    flags = ", ".join(f"if(silent_{rule}, '{rule}', null)" for rule in SILENT_RULES)
    profile = df.groupBy("sn").agg(*silent_flags(), *extra)
    kept = [c for c in profile.columns if not c.startswith("silent_")]
    return profile.selectExpr(*kept, f"array_compact(array({flags})) as reasons")


def abnormal_devices(df: DataFrame) -> DataFrame:
    """Devices that at least one rule drops, with the rules that hit."""
    return device_profile(df).filter(F.size("reasons") > 0)


def drop_abnormal_devices(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept readings, dropped devices). The anti join is planned by the size of the dropped list."""
    dropped = measured(abnormal_devices(df))
    return df.join(dropped.select("sn"), "sn", "left_anti"), dropped


def invalid_column_profile(df: DataFrame, upper: float = 6000.0) -> DataFrame:
    """Per string column the share of readings that are missing, not positive or above ``upper``."""
    columns = [c for c in df.columns if c.startswith(("ipv", "vpv"))]
    shares = [
        F.expr(
            f"avg(if({c} is null or {c} <= 0.0D or {c} > {text.number(upper)}, 1.0D, 0.0D)) as {c}"
        )
        for c in columns
    ]
    return df.agg(*shares).unpivot([], columns, "column_name", "invalid_share")


def droppable_columns(df: DataFrame, limit: float = 0.99) -> DataFrame:
    return invalid_column_profile(df).filter(F.col("invalid_share") > F.lit(limit))
