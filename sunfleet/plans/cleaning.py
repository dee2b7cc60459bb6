"""The full cleaner as one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning as c
from ..operators import lookback as lb
from ..session import measured


def clean_telemetry(df: DataFrame, cast: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean readings, dropped devices).

    The device test reads the rows before the distinct: copies can not change it, so the
    narrow per-device aggregate does not wait for the wide shuffle. ``cast=False`` is the
    variant for input whose numeric columns already are doubles.
    """
    rows = c.standard_rows(df, cast)
    dropped = measured(c.abnormal_devices(c.repair_sensors(rows)))
    kept = rows.join(dropped.select("sn"), "sn", "left_anti").select(*rows.columns)
    return c.repair_sensors(c.dedupe_rows(kept)), dropped


def clean_windows(
    df: DataFrame, newest: Column, windows_of: Callable[[DataFrame], DataFrame],
    inside: Callable[[DataFrame, DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean readings inside the windows, windows of kept devices, dropped devices).

    One narrow aggregate over all readings yields the device test and the newest reading; only
    the readings inside the windows go through the wide distinct. ``windows_of`` turns
    (sn, ``newest``) into windows, ``inside`` joins and filters.
    """
    rows = lb.with_time(c.standard_rows(df))
    profile = measured(c.device_profile(c.repair_sensors(rows), newest))
    windows = windows_of(profile.filter(F.size("reasons") == 0).drop("reasons"))
    clean = c.repair_sensors(c.dedupe_rows(inside(rows, windows).select(*rows.columns)))
    return clean, windows, profile.filter(F.size("reasons") > 0).select("sn", "reasons")
