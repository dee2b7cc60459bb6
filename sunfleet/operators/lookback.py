"""Look-back windows: whole days per device, and time spans per device."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..session import measured


def with_time(df: DataFrame, time: str = "createtime") -> DataFrame:
    """``createtime`` as timestamp; text is parsed, other types pass."""
    if dict(df.dtypes)[time] != "string":
        return df
    return df.withColumn(time, fn.parse_time(time))


def day_of(time: str = "createtime") -> Column:
    return F.to_date(F.col(time))


def last_seen(df: DataFrame) -> DataFrame:
    return df.groupBy("sn").agg(F.max(day_of()).alias("last_seen"))


def cutoff(last: Column, out_days: Column, visible_date: dt.date | None = None) -> Column:
    """First day that is no longer visible: the newest usable day minus ``out_days - 1``."""
    if visible_date is not None:
        last = F.least(last, F.lit(visible_date))
    return F.date_sub(last, out_days - 1)


def day_windows(
    devices: DataFrame, out_days: int = 0, time_range: int = 7, visible_date: dt.date | None = None
) -> DataFrame:
    """``devices`` (sn, last_seen) to (sn, start_date, last_date)."""
    last = cutoff(F.col("last_seen"), F.lit(out_days), visible_date)
    return devices.select("sn", last.alias("last_date")).withColumn(
        "start_date", F.date_sub("last_date", time_range)
    )


def device_cutoff(df: DataFrame, out_days: int = 0, visible_date: dt.date | None = None) -> DataFrame:
    """(sn, time): the cut-off list that accompanies the scores."""
    windows = day_windows(last_seen(with_time(df)), out_days, visible_date=visible_date)
    return windows.select("sn", F.col("last_date").alias("time"))


def rows_in_day_window(df: DataFrame, windows: DataFrame) -> DataFrame:
    """Readings strictly between the midnights of ``start_date`` and ``last_date``.

    An equi-join on the device with the range as residual; the window side holds one row per
    device, and a device with very many readings is split by the skew join of the runtime.
    """
    t = F.col("createtime")
    return df.join(windows, "sn").filter(
        (t > F.col("start_date").cast("timestamp")) & (t < F.col("last_date").cast("timestamp"))
    )


def date_spine(windows: DataFrame, keys: tuple[str, ...] = ("sn",)) -> DataFrame:
    """Every day of every window: ``time_range`` rows per device, also for days without a reading."""
    days = F.sequence(F.col("start_date"), F.date_sub("last_date", 1))
    return windows.select(*keys, F.posexplode(days).alias("day_idx", "date"))


def time_windows(
    newest: DataFrame, days: int = 0, out_days: int = 30, newest_visible: dt.datetime | None = None
) -> DataFrame:
    """``newest`` (sn, newest) to (sn, start_time, end_time): ``out_days`` that end ``days`` before."""
    last = F.col("newest")
    if newest_visible is not None:
        last = F.least(last, F.lit(newest_visible))
    end = last - F.make_dt_interval(F.lit(days))
    return newest.select("sn", end.alias("end_time")).withColumn(
        "start_time", F.col("end_time") - F.make_dt_interval(F.lit(out_days))
    )


def inside_time_window(df: DataFrame, windows: DataFrame) -> DataFrame:
    """``start_time <= createtime < end_time``; with ``days=0`` the newest reading is excluded."""
    t = F.col("createtime")
    joined = df.join(windows, "sn").filter((t >= F.col("start_time")) & (t < F.col("end_time")))
    return joined.select(*df.columns)


def rows_in_time_window(
    df: DataFrame, days: int = 0, out_days: int = 30, newest_visible: dt.datetime | None = None
) -> DataFrame:
    newest = measured(df.groupBy("sn").agg(F.max("createtime").alias("newest")))
    return inside_time_window(df, time_windows(newest, days, out_days, newest_visible))


def min_rows_gate(df: DataFrame, min_rows: int = 2000) -> tuple[DataFrame, DataFrame]:
    """(readings of devices with enough rows, skipped devices)."""
    counts = df.groupBy("sn").agg(F.count(F.lit(1)).alias("row_count"))
    skipped = measured(counts.filter(F.col("row_count") < min_rows))
    return df.join(skipped.select("sn"), "sn", "left_anti"), skipped


def min_days_gate(df: DataFrame, min_days: int = 15) -> tuple[DataFrame, DataFrame]:
    """(readings of devices seen on enough days, skipped devices)."""
    counts = df.groupBy("sn").agg(F.countDistinct(day_of()).alias("day_count"))
    skipped = measured(counts.filter(F.col("day_count") < min_days))
    return df.join(skipped.select("sn"), "sn", "left_anti"), skipped


def distinct_times_per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("sn", day_of().alias("date")).agg(
        F.countDistinct("createtime").alias("distinct_times")
    )


def last_full_day(df: DataFrame, min_times: int = 100) -> DataFrame:
    """(sn, date): the newest day with more than ``min_times`` distinct reading times."""
    full = distinct_times_per_day(df).filter(F.col("distinct_times") > min_times)
    return full.groupBy("sn").agg(F.max("date").alias("date"))


def last_full_day_join(df: DataFrame, min_times: int = 100) -> DataFrame:
    """All readings of each device's last full day."""
    wanted = measured(last_full_day(df, min_times))
    return df.withColumn("date", day_of()).join(wanted, ["sn", "date"])
