"""Julian dates, partition columns and the time window of a night."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# J2000.0 (2000-01-01 12:00 UTC): counting from here keeps the last digit of present-day Julian dates
J2000_JD = 2451545.0
J2000_MICROS = 946728000000000
DAY_MICROS = 86400000000.0


def to_jd(ts: Column) -> Column:
    """UTC timestamp -> Julian date."""
    return (F.unix_micros(ts) - F.lit(J2000_MICROS)).cast("double") / F.lit(DAY_MICROS) + F.lit(J2000_JD)


def from_jd(jd: Column) -> Column:
    """Julian date -> UTC timestamp (a double resolves about 40 microseconds here)."""
    micros = F.round((jd - F.lit(J2000_JD)) * F.lit(DAY_MICROS)).cast("bigint") + F.lit(J2000_MICROS)
    return F.timestamp_micros(micros)


def iso_utc(ts: Column) -> Column:
    """Timestamp -> text with milliseconds, the form of `triggerTimeUTC`."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def partition_cols(df: DataFrame, ts: str = "timestamp", jd: str = "jd") -> DataFrame:
    """Add `timestamp` (from `jd`) and year / month / day strings where they are missing."""
    if ts not in df.columns:
        df = df.withColumn(ts, from_jd(F.col(jd)))
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    return df.withColumns({c: F.date_format(ts, p) for c, p in parts.items() if c not in df.columns})


def jd_of(moment: datetime) -> float:
    micros = (moment - datetime(2000, 1, 1, 12, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return micros / DAY_MICROS + J2000_JD


def night_range(night: str, mode: str, time_window: int = 7) -> tuple[datetime, datetime]:
    """[start, end) of the notices that may explain the alerts of `night` (YYYYMMDD)."""
    midnight = datetime.strptime(night, "%Y%m%d").replace(tzinfo=timezone.utc)
    if mode == "online":
        return midnight - timedelta(hours=7), midnight + timedelta(hours=17)
    if mode == "offline":
        return midnight - timedelta(days=time_window, hours=7), midnight + timedelta(hours=18)
    raise ValueError(f"mode is 'online' or 'offline', not {mode!r}")


def night_bounds(notices: DataFrame, night: str, mode: str, time_window: int = 7) -> DataFrame:
    """Notices of the night's window.

    The Julian-date range is pushed to the files; the day range on the partition columns, when the table has
    them, prunes whole directories before that.
    """
    start, end = night_range(night, mode, time_window)
    inside = (F.col("triggerTimejd") >= jd_of(start)) & (F.col("triggerTimejd") < jd_of(end))
    if {"year", "month", "day"} <= set(notices.columns):
        days = [start + timedelta(days=i) for i in range((end.date() - start.date()).days + 1)]
        day = [f"{d:%Y%m%d}" for d in days]
        inside = F.concat("year", "month", "day").isin(day) & inside
    return notices.filter(inside)
