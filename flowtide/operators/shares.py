"""Dashboard tables: global and top-protocol series, concentration shares, treemap."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.operators.aggregates import tvl_on_days
from flowtide.plans.running import with_running_totals
from flowtide.plans.skew import skewed_join


def global_series(positions: DataFrame, ordered: bool = True) -> DataFrame:
    """Value per (type, date) of aggregated positions."""
    series = positions.groupBy("type", "aggregated_date").agg(F.sum("usd").alias("usd"))
    return series.orderBy(F.asc_nulls_last("type"), "aggregated_date") if ordered else series


def top_protocol_series(positions: DataFrame, top_x: int, ordered: bool = True) -> DataFrame:
    """Value per (type, protocol, date) of the ``top_x`` protocols with the largest mean value.

    The planner decides by size how the chosen names meet the positions.
    """
    means = positions.groupBy("protocol_name").agg(F.avg("usd").alias("avg_usd"))
    top = means.orderBy(F.desc_nulls_last("avg_usd"), "protocol_name").limit(top_x)
    chosen = positions.join(top.select("protocol_name"), "protocol_name", "left_semi")
    series = chosen.groupBy("type", "protocol_name", "aggregated_date").agg(F.sum("usd").alias("usd"))
    return series.orderBy(F.asc_nulls_last("type"), "protocol_name", "aggregated_date") if ordered else series


def top_shares(facts: DataFrame, protocols: DataFrame, days: Iterable[str | date]) -> DataFrame:
    """Individual and cumulative share of every protocol on the given days (one per year).

    Largest first within a year, ties by id and name; ``protocol_amount`` is the zero-based rank.
    """
    totals = tvl_on_days(facts, protocols, days).withColumn("year", F.year("day").cast("string"))
    largest_first = [F.desc_nulls_last("total_usd_value"), F.asc("id"), F.asc_nulls_last("name")]
    ranked = with_running_totals(totals, "year", largest_first, "total_usd_value")
    cumulative = F.try_divide("running_total", "group_total")
    individual = F.try_divide("total_usd_value", "group_total")
    return ranked.select(
        "id",
        "name",
        "total_usd_value",
        cumulative.alias("cumulative_share"),
        individual.alias("individual_share"),
        (cumulative * 100).alias("cumulative_share_percentage"),
        (individual * 100).alias("individual_share_percentage"),
        "year",
        (F.col("row_number") - 1).alias("protocol_amount"),
    )


def threshold_labels(shares: DataFrame, percentage: float = 90) -> DataFrame:
    """Flag the protocols that together stay below ``percentage`` and label each year ``year (below/total)``."""
    flagged = shares.withColumn("is_below_threshold", F.col("cumulative_share_percentage") < percentage)
    summary = flagged.groupBy("year").agg(
        F.coalesce(F.sum(F.col("is_below_threshold").cast("bigint")), F.lit(0)).alias("below_threshold"),
        F.count("is_below_threshold").alias("total"),
    )
    label = F.format_string("%s (%d/%d)", "year", "below_threshold", "total")
    return skewed_join(flagged, summary.withColumn("legend_label", label), ["year"])


def treemap(shares: DataFrame) -> DataFrame:
    """Value and value-weighted mean share of every (year, name), year, and the whole.

    Parents have NULL in the columns they summarise; ``level`` is 2 for leaves, 1 for years, 0 for the root.
    """
    share = F.col("individual_share_percentage")
    value = F.col("total_usd_value")
    shown = shares.where(share.isNotNull() & (share > 0))
    return shown.rollup("year", "name").agg(
        (F.lit(2) - F.grouping("year") - F.grouping("name")).alias("level"),
        F.sum(value).alias("total_usd_value"),
        F.try_divide(F.sum(value * share), F.sum(value)).alias("mean_share_percentage"),
    )
