"""Daily aggregates per device: one ``groupBy`` with conditional aggregates for all families.

The four filtered blocks of a day (all readings, AC connected, midday, 9-15 h) are conditions
inside the aggregates, so one pass and one shuffle of partial results replace three joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schema import IAC, IPV, VAC, VPV
from .lookback import day_of


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the daily features; every one is a parameter of the job."""

    ipv_peak: float = 5000.0
    vpv_rated: float = 1050.0
    vpv_spikes: Sequence[float] = (0.8, 0.9, 1.0, 1.1, 1.2)
    vpv_sags: Sequence[float] = (0.05, 0.1)
    vac_rated: float = 220.0
    vac_spikes: Sequence[float] = (1.1, 1.2, 1.3)
    vac_sags: Sequence[float] = (0.8, 0.9, 1.0)
    vpv_noise: float = 200.0
    midday: tuple[int, int] = (11, 15)
    energy_hours: tuple[int, int] = (9, 15)


DEFAULTS = Thresholds()
DRAFT = Thresholds(vpv_noise=250.0)


def tag(amplitude: float) -> str:
    """``0.8`` -> ``0_8``: column names inside Spark carry no dots."""
    return str(amplitude).replace(".", "_")


def _flag(condition: str) -> str:
    """1 if the condition holds in any row; a missing value counts as not holding."""
    return f"max(if({condition}, 1, 0))"


def error_rate() -> dict[str, str]:
    status = text.error_status()
    return {"error_rate": f"avg(case when {status} then 1.0D when not {status} then 0.0D end)"}


def error_occur() -> dict[str, str]:
    return {"error_occur": _flag(text.error_status())}


def on_rate() -> dict[str, str]:
    return {"on_rate": "avg(switchstatus)"}


def ipv_peaks(t: Thresholds = DEFAULTS) -> dict[str, str]:
    return {f"{c}_peaks": _flag(f"{c} > {text.number(t.ipv_peak)}") for c in IPV}


def _exceedances(columns, rated, amplitudes, above: bool) -> dict[str, str]:
    sign, kind = (">", "spikes") if above else ("<", "sags")
    return {
        f"{c}_{tag(a)}_{kind}": f"count_if({c} {sign} {text.number(rated * a)})"
        for c in columns
        for a in amplitudes
    }


def vpv_spikes(t: Thresholds = DEFAULTS) -> dict[str, str]:
    return _exceedances(VPV, t.vpv_rated, t.vpv_spikes, True)


def vpv_sags(t: Thresholds = DEFAULTS) -> dict[str, str]:
    return _exceedances(VPV, t.vpv_rated, t.vpv_sags, False)


def vac_spikes(t: Thresholds = DEFAULTS) -> dict[str, str]:
    return _exceedances(VAC, t.vac_rated, t.vac_spikes, True)


def vac_sags(t: Thresholds = DEFAULTS) -> dict[str, str]:
    return _exceedances(VAC, t.vac_rated, t.vac_sags, False)


def iac_peaks() -> dict[str, str]:
    """Readings above the device's rated current; the threshold is a column, not a constant."""
    return {f"{c}_peaks": f"count_if({c} > {text.rated_current('sn')})" for c in IAC}


def mean_variance(columns: Iterable[str]) -> dict[str, str]:
    """Mean and sample variance of the readings with AC connected; one reading has no variance."""
    out = {}
    for c in columns:
        connected = f"if({text.ac_connected()}, {c}, null)"
        out[f"{c}_mean"] = f"avg({connected})"
        out[f"{c}_variance"] = f"var_samp({connected})"
    return out


def midday_temperature(t: Thresholds = DEFAULTS) -> dict[str, str]:
    wanted = f"{text.ac_connected()} and {text.in_hours('createtime', *t.midday)}"
    return {"temperature_mean": f"avg(if({wanted}, temperature, null))"}


def energy(t: Thresholds = DEFAULTS) -> dict[str, str]:
    """First and last energy counter in the band (ties on time: by counter) and its on-rate."""
    wanted = text.in_hours("createtime", *t.energy_hours)
    reading = f"if({wanted}, struct(createtime, eday), null)"
    return {
        "eday_start": f"min({reading}).eday",
        "eday_end": f"max({reading}).eday",
        "on_rate_4_eday": f"avg(if({wanted}, switchstatus, null))",
    }


def phase_imbalance() -> dict[str, str]:
    return {"vac_horizontal_variance": f"avg({text.phase_variance(VAC)})"}


def active_power_mean(t: Thresholds = DEFAULTS) -> dict[str, str]:
    wanted = text.in_hours("createtime", *t.energy_hours)
    return {"activepower_mean": f"avg(if({wanted}, activepower, null))"}


FAMILIES = {
    "error": lambda t: {**error_rate(), **error_occur()},
    "switch": lambda t: on_rate(),
    "ipv_peaks": ipv_peaks,
    "iac_peaks": lambda t: iac_peaks(),
    "vpv_spikes": vpv_spikes,
    "vpv_sags": vpv_sags,
    "vac_spikes": vac_spikes,
    "vac_sags": vac_sags,
    "vac": lambda t: mean_variance(VAC),
    "vpv": lambda t: mean_variance(VPV),
    "temperature": midday_temperature,
    "energy": energy,
}
DRAFT_FAMILIES = {
    "phase_imbalance": lambda t: phase_imbalance(),
    "power": active_power_mean,
}


@dataclass(frozen=True)
class DailySpec:
    """Which families to compute, with which thresholds and caller-defined ratios (name -> column)."""

    families: Sequence[str] = tuple(FAMILIES)
    thresholds: Thresholds = DEFAULTS
    ratios: dict[str, Column] = field(default_factory=dict)

    def aggregates(self) -> list[Column]:
        known = {**FAMILIES, **DRAFT_FAMILIES}
        chosen: dict[str, str] = {}
        for family in self.families:
            chosen.update(known[family](self.thresholds))
        means = [F.avg(expression).alias(name) for name, expression in self.ratios.items()]
        return [F.expr(a) for a in text.named(chosen)] + means


EVERYTHING = DailySpec()


def pack_by_hour(df: DataFrame) -> DataFrame:
    """Bring the readings of a device-hour together before a wide aggregate.

    A partial daily row is several times wider than a reading, so partial aggregation only
    pays once a task holds many readings of the same device-day. Hours rather than whole
    devices are the unit, so a device with very many readings still spreads over many tasks.
    """
    return df.repartition(F.col("sn"), F.date_trunc("hour", F.col("createtime")))


def daily_aggregates(
    df: DataFrame, spec: DailySpec = EVERYTHING, extra_keys: Sequence[str] = (), day: Column | None = None
) -> DataFrame:
    """One row per (device, day with readings); ``day`` is a column that already holds it."""
    day = day_of() if day is None else day
    return df.groupBy("sn", *extra_keys, day.alias("date")).agg(*spec.aggregates())
