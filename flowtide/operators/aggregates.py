"""Aggregations over positions.

Joins to the protocol dimension come after a first aggregation of the facts, so what they shuffle
is one row per group, not per fact.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.functions.calendar import SECONDS_PER_DAY, as_day, bucket, epoch_seconds, shift, utc_date
from flowtide.functions.predicates import epoch_range
from flowtide.operators.lookup import category_to_type
from flowtide.plans.skew import skewed_join


def token_frequency(facts: DataFrame, ordered: bool = True) -> DataFrame:
    counts = facts.groupBy("token_name").agg(F.count("*").alias("frequency"))
    return counts.orderBy(F.desc("frequency"), F.asc_nulls_last("token_name")) if ordered else counts


def latest_dates(facts: DataFrame) -> DataFrame:
    return facts.groupBy("id", "chain_name", "token_name").agg(F.max("date").alias("latest_date"))


def protocol_activity_counts(facts: DataFrame, granularity: str = "month", ordered: bool = True) -> DataFrame:
    counts = facts.groupBy(bucket(granularity).alias("period"), "id").agg(F.count("*").alias("entry_count"))
    return counts.orderBy("period", F.asc_nulls_last("id")) if ordered else counts


def day_entry_counts(facts: DataFrame, ordered: bool = True) -> DataFrame:
    counts = facts.groupBy(bucket("day").alias("aggregated_date")).agg(F.count("*").alias("entry_count"))
    return counts.orderBy("aggregated_date") if ordered else counts


def _details(protocols: DataFrame) -> DataFrame:
    return protocols.select("id", F.col("name").alias("protocol_name"), "category", "type")


def _positive(facts: DataFrame) -> DataFrame:
    return facts.where((F.col("quantity") > 0) & (F.col("value_usd") > 0))


def token_distribution_sum(
    facts: DataFrame, protocols: DataFrame, token_name: str, granularity: str, ordered: bool = True
) -> DataFrame:
    """Summed positions of one token per bucket, protocol and chain."""
    partial = (
        _positive(facts.where(F.col("token_name") == token_name))
        .groupBy(bucket(granularity).alias("aggregated_date"), "id", "chain_name")
        .agg(F.sum("quantity").alias("_quantity"), F.sum("value_usd").alias("_value"))
    )
    result = (
        skewed_join(partial, _details(protocols), ["id"], "inner")
        .groupBy("aggregated_date", "id", "protocol_name", "category", "type", "chain_name")
        .agg(F.sum("_quantity").alias("total_quantity"), F.sum("_value").alias("total_value_usd"))
    )
    return result.orderBy("aggregated_date", "id") if ordered else result


def aggregated_positions(
    facts: DataFrame,
    protocols: DataFrame,
    category_map: DataFrame,
    granularity: str,
    token_name: str | None = None,
    protocol_name: str | None = None,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Mean positions per bucket, protocol, chain and token, with ``type`` set to the broad category.

    The date range is inclusive and applies only when both ends are given.
    """
    rows = facts
    if token_name:
        rows = rows.where(F.col("token_name") == token_name)
    if start_date and end_date:
        rows = rows.where(F.col("date").between(epoch_seconds(start_date), epoch_seconds(end_date)))
    details = _details(protocols)
    if protocol_name:
        details = details.where(F.col("protocol_name") == protocol_name)
        rows = skewed_join(rows, details.select("id"), ["id"], "left_semi")
    partial = (
        _positive(rows)
        .groupBy(bucket(granularity).alias("aggregated_date"), "id", "chain_name", "token_name")
        .agg(F.sum("quantity").alias("_quantity"), F.sum("value_usd").alias("_value"), F.count("*").alias("_rows"))
    )
    # a key has one row here, and one for each different protocol of its id behind the join: nothing is left to add up
    means = skewed_join(partial, details.distinct(), ["id"], "inner").select(
        "aggregated_date", "id", "protocol_name", "category", "type", "chain_name", "token_name",
        (F.col("_quantity") / F.col("_rows")).alias("qty"), (F.col("_value") / F.col("_rows")).alias("usd"),
    )
    typed = category_to_type(means, category_map)
    return typed.orderBy("aggregated_date", "id") if ordered else typed


def token_distribution_mean(
    facts: DataFrame, protocols: DataFrame, category_map: DataFrame, token_name: str, granularity: str
) -> DataFrame:
    return aggregated_positions(facts, protocols, category_map, granularity, token_name=token_name)


def protocol_data(
    facts: DataFrame, protocols: DataFrame, category_map: DataFrame, protocol_name: str, granularity: str
) -> DataFrame:
    return aggregated_positions(facts, protocols, category_map, granularity, protocol_name=protocol_name)


def month_averages(facts: DataFrame, year: int, month: int) -> DataFrame:
    """Mean positions per (id, chain, token) in one calendar month."""
    first = date(year, month, 1)
    in_month = epoch_range(epoch_seconds(first), epoch_seconds(shift(first, "month")))
    return (
        facts.where(in_month)
        .groupBy("id", "chain_name", "token_name")
        .agg(F.avg("quantity").alias("avg_quantity"), F.avg("value_usd").alias("avg_value_usd"))
        .select("id", "chain_name", "token_name", F.lit(first).alias("year_month"), "avg_quantity", "avg_value_usd")
    )


def tvl_on_days(facts: DataFrame, protocols: DataFrame, days: Iterable[str | date]) -> DataFrame:
    """Value per protocol on each of the given UTC days, in one job."""
    on_days = F.lit(False)
    for day in days:
        start = epoch_seconds(as_day(day))
        on_days |= epoch_range(start, start + SECONDS_PER_DAY)
    partial = (
        facts.where(on_days)
        .groupBy(utc_date(F.col("date")).alias("day"), "id")
        .agg(F.sum("value_usd").alias("_value"))
    )
    return (
        partial.join(protocols.select("id", "name"), "id")
        .groupBy("day", "id", "name")
        .agg(F.sum("_value").alias("total_usd_value"))
    )


def tvl_distribution_on_day(
    facts: DataFrame, protocols: DataFrame, day: str | date, ordered: bool = True
) -> DataFrame:
    result = tvl_on_days(facts, protocols, [day]).drop("day")
    return result.orderBy(F.desc_nulls_last("total_usd_value"), "id") if ordered else result


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row groups that occur more than once."""
    counts = df.groupBy(*df.columns).agg(F.count("*").alias("duplicate_count"))
    return counts.where(F.col("duplicate_count") > 1)


def detect_duplicates(df: DataFrame) -> DataFrame:
    """``duplicate_rows`` with each row as a JSON text."""
    as_json = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return duplicate_rows(df).select(as_json.alias("json_representation"), "duplicate_count")


def remove_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
