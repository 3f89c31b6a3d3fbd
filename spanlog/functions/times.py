"""Calendar helpers on TIMESTAMP columns (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grains, their text formats and their steps.
GRAIN_UNIT = {"month": "month", "week": "week", "day": "day", "hour": "hour",
              "5min": "minute", "minute": "minute", "second": "second"}
GRAIN_STEP = {"month": "INTERVAL 1 MONTH", "week": "INTERVAL 7 DAYS", "day": "INTERVAL 1 DAY",
              "hour": "INTERVAL 1 HOUR", "5min": "INTERVAL 5 MINUTES", "minute": "INTERVAL 1 MINUTE",
              "second": "INTERVAL 1 SECOND"}
BUCKET_FORMAT = {"month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def step(grain: str) -> Column:
    return F.expr(GRAIN_STEP[grain])


def floor_to(grain: str, t) -> Column:
    """Start of the grain containing ``t`` (weeks start on Monday)."""
    t = _c(t)
    if grain == "5min":
        return F.timestamp_seconds(F.floor(F.unix_timestamp(t) / 300) * 300)
    return F.date_trunc(GRAIN_UNIT[grain], t)


def ceil_to(grain: str, t) -> Column:
    """First grain boundary at or after ``t``."""
    t = _c(t)
    f = floor_to(grain, t)
    return F.when(f < t, f + step(grain)).otherwise(f)


def epoch(t) -> Column:
    return F.unix_timestamp(_c(t)).cast("long")


def days_between(later, earlier) -> Column:
    """Fractional days, as julianday(a) - julianday(b)."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))).cast("double") / F.lit(86400e6)


def year_week(t) -> Column:
    """Text ``%Y %W``: Monday weeks numbered within the year (week 00 before the first Monday)."""
    t = _c(t)
    monday0 = (F.dayofweek(t) + 5) % 7
    week = F.floor((F.dayofyear(t) - 1 - monday0 + 7) / 7).cast("int")
    return F.concat(F.year(t).cast("string"), F.lit(" "), F.lpad(week.cast("string"), 2, "0"))


def throttle_bucket(grain: str, t) -> Column:
    """Bucket text of the reference's run throttle (hourly/daily/weekly/monthly/always)."""
    t = _c(t)
    if grain == "hourly":
        return F.date_format(t, "yyyy-MM-dd HH")
    if grain == "daily":
        return F.date_format(t, "yyyy-MM-dd")
    if grain == "weekly":
        return year_week(t)
    if grain == "monthly":
        return F.date_format(t, "yyyy-MM")
    return F.date_format(t, "yyyy-MM-dd HH:mm:ss")
