"""Histories by period as stored tables, of which only the periods that new rows touch are computed again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.functions.calendar import bucket, epoch_seconds, shift
from flowtide.functions.predicates import epoch_range

#: Folder column: the period's first day.
DAY = "period_day"


def write_history(rows: DataFrame, path: str) -> None:
    """``rows(period, ...)`` in a folder per period; periods that are not among them stay as they are, files and all.

    Rows of a period are dealt out by their content, so a period of any size spreads over several files.
    """
    named = rows.withColumn(DAY, F.date_format("period", "yyyy-MM-dd"))
    spread = named.repartition(DAY, F.pmod(F.xxhash64(*rows.columns), F.lit(4)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_history(like: DataFrame, path: str) -> DataFrame:
    """The stored rows, with the columns of ``like``."""
    return like.sparkSession.read.schema(like.schema).parquet(path).select(*like.columns)


def update_history(facts: DataFrame, new: DataFrame, path: str, granularity: str, build: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Compute the periods of ``new`` again from ``facts``, which hold them already, and put them in the place of the stored ones.

    ``build`` turns facts into rows with a ``period``, each period from its own facts alone. Only facts of these periods are
    read: the filter is one of ranges of ``date``. Returns the periods' first days.
    """
    touched = sorted(r.day for r in new.select(bucket(granularity).cast("date").alias("day")).dropna().distinct().collect())
    if not touched:
        return []
    wanted = F.lit(False)
    for day in touched:
        wanted |= epoch_range(epoch_seconds(day), epoch_seconds(shift(day, granularity)))
    rows = build(facts.where(wanted))
    write_history(rows.where(F.col("period").cast("date").isin(touched)), path)
    return [str(day) for day in touched]
