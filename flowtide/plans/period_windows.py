"""Assign epoch-second rows to a spine of windows that overlap in their boundary instants."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.functions.calendar import as_day, date_spine, day_number, epoch_seconds, shift


def assign_windows(
    facts: DataFrame, start: str | date, end: str | date, granularity: str, column: str = "window_start"
) -> DataFrame:
    """Rows of ``facts`` once per window holding them; a window is ``[day, day + 1 unit]``, both ends included.

    The range condition becomes an equi-join on the day number: each window lists the days it touches. That
    table has one row per day of the span plus one per window, so its size follows from the arguments
    alone, and Spark decides by it how to join.
    """
    first, last = as_day(start), as_day(end)
    limit = shift(last, granularity)
    days = _window_days(facts.sparkSession, first, last, granularity, column)
    in_span = F.col("date").between(epoch_seconds(first), epoch_seconds(limit))
    return (
        facts.where(in_span)
        .withColumn("_day", day_number(F.col("date")))
        .join(days, "_day")
        .where(F.col("date") <= F.col("_until"))
        .drop("_day", "_until")
    )


def _window_days(spark: SparkSession, first: date, last: date, granularity: str, column: str) -> DataFrame:
    spine = date_spine(spark, first, last, granularity)
    # add_months clamps to the end of the month, as shift() does
    until = {
        "day": F.date_add("day", 1),
        "week": F.date_add("day", 7),
        "month": F.add_months("day", 1),
        "year": F.add_months("day", 12),
    }[granularity]
    low, high = F.unix_date("day"), F.unix_date(until)
    return spine.select(
        F.col("day").alias(column),
        F.explode(F.sequence(low, high)).alias("_day"),
        (high.cast("bigint") * 86_400).alias("_until"),
    )
