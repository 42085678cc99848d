"""Service-day times and dates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from reachspark.schemas import MAX_TIME

TIME = r"^(\d+):([0-5]\d):([0-5]\d)$"


def seconds(text: Column) -> Column:
    """Seconds of H:MM:SS with unbounded hours; null if malformed or beyond 32 bits."""
    t = F.trim(text)
    part = lambda k: F.regexp_extract(t, TIME, k).try_cast("long")
    v = F.when(t.rlike(TIME) & (F.length(t) <= 20), part(1) * 3600 + part(2) * 60 + part(3))
    return F.when(v <= MAX_TIME, v)


def valid_date(text: Column) -> Column:
    """Whether YYYYMMDD names a day, year 0 not being one."""
    return F.coalesce(text.rlike(r"^\d{8}$") & (F.substring(text, 1, 4) != "0000") & F.try_to_date(text, "yyyyMMdd").isNotNull(), F.lit(False))


def clock(text: str) -> int:
    """Seconds of HH:MM:SS within a civil day."""
    h, m, s = (int(x) for x in text.split(":"))
    if not (0 <= h < 24 and 0 <= m < 60 and 0 <= s < 60):
        raise ValueError(f"not a clock time: {text}")
    return h * 3600 + m * 60 + s


def gtfs_date(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def weekday_index(day: Column) -> Column:
    """0 for Sunday."""
    return F.dayofweek(day) - 1


def feed_dates(start: date, end: date) -> list[str]:
    return [(start + timedelta(n)).strftime("%Y%m%d") for n in range((end - start).days + 1)]


def minutes_up(secs: Column) -> Column:
    return F.ceil(secs / 60).cast("int")
