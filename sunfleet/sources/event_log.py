"""Telemetry readings derived from a generic event log.

An event (``event_id, ts, user_id, event_type, props``) becomes one reading of device
``user_id``; the number in ``props`` drives the metrics. Sentinels, counter wraps, missing
values and devices that report nothing all occur, so every cleaning rule has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import named
from ..schema import CORE_COLUMNS, PHASES, STRINGS

KILOWATTS = [10, 12, 15, 17, 20, 25, 30, 33, 36, 40]


def kilowatt(user: str) -> str:
    return f"element_at(array({', '.join(str(k) for k in KILOWATTS)}), cast({user} % 10 + 1 as int))"


def device_id(user: str) -> str:
    """SQL text of the device id of a user."""
    return (
        f"concat(if({user} % 11 = 0, 'XX', 'TP'), cast({kilowatt(user)} as string), 'KBT000B', "
        f"lpad(cast({user} as string), 9, '0'))"
    )


def _metrics() -> dict[str, str]:
    u, k = "user_id", "k"
    out = {"sn": device_id(u), "createtime": "date_trunc('second', cast(ts as timestamp))"}
    for i in STRINGS:
        level = f"cast(({k} * 13 + {97 * i}) % 131 as double) * 10"
        if i == 6:
            level = f"case when {u} % 3 = 0 then cast(({k} * 13 + 582) % 15 as double) * 10 else {level} end"
        out[f"vpv{i}"] = f"case when {k} % 29 = {i} then 6553.5D when {u} % 13 = 0 then 0.0D else {level} end"
        out[f"ipv{i}"] = (
            f"case when {k} % 31 = {i} then 6553.5D when {u} % 17 = 0 then 0.0D "
            f"else cast(({k} * 7 + {11 * i}) % 120 as double) / 10 end"
        )
    for i in PHASES:
        out[f"vac{i}"] = f"cast(170 + ({k} * 17 + {5 * i}) % 123 as double)"
        out[f"iac{i}"] = f"case when {u} % 19 = 0 then 0.0D else cast(({k} * 3 + {19 * i}) % 61 as double) end"
    out["temperature"] = f"case when {k} % 37 <> 0 then cast(20 + ({k} * 11) % 45 as double) end"
    out["switchstatus"] = f"if({k} % 7 = 0, 0.0D, 1.0D)"
    out["errorcode"] = (
        f"case when event_type = 'error' then '17' when event_type = 'view' and {k} % 10 = 0 then null else '0' end"
    )
    out["eday"] = f"cast((hour(ts) * 60 + minute(ts)) * {kilowatt(u)} as double) / 20"
    out["etotal"] = "cast(event_id as double)"
    out["ttotal"] = f"if({u} % 23 = 0, 0.0D, cast(event_id + 1 as double))"
    out["activepower"] = f"cast({k} * 100 as double)"
    out["pac"] = f"cast({k} * 100 as double)"
    out["outputpowerratio"] = f"cast({k} as double)"
    out["inspectingpower"] = f"cast({k} * 200 as double)"
    out["reactivepower"] = f"cast(if({k} % 5 = 0, 16777216 - 10 * {k}, 10 * {k}) as double)"
    out["powerfactor"] = (
        f"case when {k} % 9 = 0 and {k} > 0 then 65.536D - cast({k} as double) / 100 else cast({k} as double) / 100 end"
    )
    out["fac1"] = f"50.0D + cast({k} % 5 as double) / 100"
    out["fac2"] = f"50.0D - cast({k} % 5 as double) / 100"
    return out


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """The 34 core columns plus ``user_id`` and ``k`` (the number in ``props``)."""
    metrics = _metrics()
    numbered = events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k"
    )
    return numbered.selectExpr(*named({c: metrics[c] for c in CORE_COLUMNS}), "user_id", "k")


def read_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry of the event log stored in ``folder``, without the helper columns."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return telemetry_from_events(events).select(*CORE_COLUMNS)
