"""Calendar buckets and date spines. Everything is in UTC and independent of the session time zone."""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRANULARITIES = ("day", "week", "month", "year")
SECONDS_PER_DAY = 86_400
_EPOCH = date(1970, 1, 1)


def check_granularity(granularity: str) -> str:
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}, not {granularity!r}")
    return granularity


def as_day(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def epoch_seconds(day: str | date) -> int:
    return (as_day(day) - _EPOCH).days * SECONDS_PER_DAY


def shift(day: date, granularity: str, steps: int = 1) -> date:
    """``day`` moved by calendar units; month and year steps clamp to the end of the month."""
    check_granularity(granularity)
    if granularity in ("day", "week"):
        return day + timedelta(days=steps * (7 if granularity == "week" else 1))
    months = day.year * 12 + day.month - 1 + steps * (12 if granularity == "year" else 1)
    year, month = divmod(months, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def day_number(seconds: Column) -> Column:
    return F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int")


def utc_date(seconds: Column) -> Column:
    return F.date_from_unix_date(day_number(seconds))


def bucket(granularity: str, seconds: Column | str = "date") -> Column:
    """Start of the day, Monday week, month or year holding an epoch second, as TIMESTAMP_NTZ."""
    check_granularity(granularity)
    day = utc_date(F.col(seconds) if isinstance(seconds, str) else seconds)
    start = day if granularity == "day" else F.trunc(day, granularity)
    return start.cast("timestamp_ntz")


def date_spine(spark: SparkSession, start: str | date, end: str | date, granularity: str) -> DataFrame:
    """``start``, ``start`` + 1 unit, … up to ``end``, both inclusive."""
    check_granularity(granularity)
    step = F.expr(f"interval 1 {granularity}")
    days = F.sequence(F.lit(as_day(start)), F.lit(as_day(end)), step)
    return spark.range(1).select(F.explode(days).alias("day"))


def first_days_of_years(last_year: int, years: int = 5) -> list[date]:
    return [date(year, 1, 1) for year in range(last_year - years + 1, last_year + 1)]
