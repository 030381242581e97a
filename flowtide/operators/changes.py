"""Period-over-period changes of positions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.calendar import as_day, bucket, epoch_seconds, shift
from flowtide.functions.predicates import chain_filter
from flowtide.plans.first_last import first_last_pairs
from flowtide.plans.period_windows import assign_windows
from flowtide.plans.skew import expand_copies, skewed_join

KEYS = ["id", "chain_name", "token_name"]


def _with_details(pairs: DataFrame, protocols: DataFrame, period: list[str], first_date: Column) -> DataFrame:
    details = protocols.select("id", F.col("name").alias("protocol_name"), "category", "type")
    return skewed_join(pairs, details, ["id"], "inner").select(
        "id",
        "protocol_name",
        "category",
        "type",
        "chain_name",
        "token_name",
        *period,
        first_date,
        "last_date",
        "qty",
        "usd",
        (F.col("last_qty") - F.col("qty")).alias("qty_change"),
        (F.col("last_usd") - F.col("usd")).alias("usd_change"),
        "copies",
    )


def _finish(changes: DataFrame, unique: bool, folded: bool) -> DataFrame:
    if folded:
        return changes
    return changes.drop("copies") if unique else expand_copies(changes)


def compare_periods(
    facts: DataFrame,
    protocols: DataFrame,
    start_date: str | date,
    granularity: str = "day",
    chains: str = "exclude_borrowed",
    unique: bool = False,
    folded: bool = True,
) -> DataFrame:
    """First-to-last change of every position with at least two rows in ``[start, start + 1 unit]``.

    Repeated rows at a boundary date fan out. Equal result rows are folded, with their number in ``copies`` (the network
    operators weigh by it); ``folded=False`` writes them out. ``unique=True`` promises that (id, chain, token, date) is
    unique and takes the one-shuffle plan; a boundary date that breaks the promise is an error.
    """
    first = as_day(start_date)
    in_window = F.col("date").between(epoch_seconds(first), epoch_seconds(shift(first, granularity)))
    pairs = first_last_pairs(facts.where(in_window & chain_filter(chains)), KEYS, min_rows=2, unique=unique)
    return _finish(_with_details(pairs, protocols, [], F.col("first_date")), unique, folded)


def historical_changes(
    facts: DataFrame,
    protocols: DataFrame,
    granularity: str,
    start_date: str | date,
    unique: bool = False,
    folded: bool = True,
    ordered: bool = False,
) -> DataFrame:
    """First-to-last change inside every period from ``start_date`` on; a single row is a change of 0."""
    rows = facts.where(F.col("date") >= epoch_seconds(start_date)).withColumn("period", bucket(granularity))
    pairs = first_last_pairs(rows, [*KEYS, "period"], unique=unique)
    changes = _with_details(pairs, protocols, ["period"], F.col("first_date").alias("date"))
    result = _finish(changes, unique, folded)
    return result.orderBy("period", "id") if ordered else result


def period_snapshots(
    facts: DataFrame,
    protocols: DataFrame,
    start: str | date,
    end: str | date,
    granularity: str,
    chains: str = "exclude_borrowed",
    unique: bool = False,
    folded: bool = True,
) -> DataFrame:
    """``compare_periods`` for every date of a spine in one job, keyed by ``period`` (a DATE).

    Neighbouring windows share their boundary instant, so a row there belongs to both.
    """
    rows = assign_windows(facts.where(chain_filter(chains)), start, end, granularity, "period")
    pairs = first_last_pairs(rows, [*KEYS, "period"], min_rows=2, unique=unique)
    return _finish(_with_details(pairs, protocols, ["period"], F.col("first_date")), unique, folded)
