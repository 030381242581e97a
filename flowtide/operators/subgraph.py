"""Bounded subgraphs for display: top nodes of a network, top communities of a time slice."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.functions.calendar import as_day
from flowtide.plans.skew import skewed_join

# fixed values: how many communities and members are shown, and the size scale
TOP_COMMUNITIES = 3
TOP_MEMBERS = 50
VISUAL_SCALE = 10_000


class Subgraph(NamedTuple):
    nodes: DataFrame
    edges: DataFrame


def _scaled(rows: DataFrame, low: float, high: float) -> DataFrame:
    """Add ``visual_size``, min-max scaled over the whole frame; ``low`` where all sizes are equal."""
    ends = rows.agg(F.struct(F.min("size").alias("low"), F.max("size").alias("high")).alias("ends")).select("ends").scalar()
    share = (F.col("size") - ends["low"]) / (ends["high"] - ends["low"])
    scaled = F.when(ends["high"] > ends["low"], share * (high - low) + low).otherwise(F.lit(low))
    return rows.withColumn("visual_size", scaled)


def _renamed(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    lookup = names.select(F.col("id").alias(column), F.col("name").alias("_name"))
    return skewed_join(df, lookup, [column]).withColumn(column, F.coalesce("_name", column)).select(*df.columns)


def top_network(
    nodes: DataFrame,
    links: DataFrame,
    names: DataFrame | None = None,
    top_x: int = 100,
    node_range: tuple[float, float] = (10.0, 30.0),
    edge_range: tuple[float, float] = (1.0, 5.0),
) -> Subgraph:
    """The ``top_x`` largest nodes and the links among them, with display names and scaled sizes.

    ``nodes`` has ``id, size``, ``links`` has ``source, target, size``, ``names`` maps ``id`` to ``name``.
    """
    ranked = nodes.select("id", "size").orderBy(F.desc("size"), F.asc_nulls_last("id")).limit(top_x)
    candidates = links.select("source", "target", "size")
    if names is not None:
        named = _renamed(nodes.select("id", "size"), names, "id")
        ranked = named.orderBy(F.desc("size"), F.asc_nulls_last("id")).limit(top_x)
        candidates = _renamed(_renamed(candidates, names, "source"), names, "target")
    chosen = ranked.select(F.col("id").alias("chosen")).distinct()
    inside = candidates.join(chosen, F.col("source").eqNullSafe(F.col("chosen")), "left_semi").join(
        chosen, F.col("target").eqNullSafe(F.col("chosen")), "left_semi"
    )
    return Subgraph(
        _scaled(ranked, *node_range),
        _scaled(inside, *edge_range),
    )


def edge_weights(edges: DataFrame, order_by: str = "size") -> DataFrame:
    """``log1p(size)`` of the edges of each time slice; of repeated edges the last by ``order_by`` counts."""
    last = F.max_by("size", order_by)
    return edges.groupBy("time", "source", "target").agg(F.log1p(last).alias("weight"))


def top_communities(
    members: DataFrame,
    edges: DataFrame,
    shock: str | date | None = None,
    communities: int = TOP_COMMUNITIES,
    per_community: int = TOP_MEMBERS,
) -> Subgraph:
    """Largest communities of every time slice, their largest members, and the edges inside them.

    ``members`` has ``time, community, node, size``. Both rankings keep a fixed number of rows per group, which
    Spark cuts before the shuffle.
    """
    size = F.coalesce("size", F.lit(0.0))
    totals = members.groupBy("time", "community").agg(F.sum(size).alias("community_size"))
    by_total = W.partitionBy("time").orderBy(F.desc("community_size"), "community")
    best = (
        totals.withColumn("rank", F.row_number().over(by_total))
        .where(F.col("rank") <= communities)
        .select("time", "community", F.col("rank").alias("community_rank"))
    )
    by_size = W.partitionBy("time", "community").orderBy(F.desc(size), "node")
    largest = (
        members.withColumn("_rank", F.row_number().over(by_size))
        .where((F.col("_rank") <= per_community) & F.col("size").isNotNull())
        .drop("_rank")
    )
    is_shock = F.lit(False) if shock is None else F.to_date("time") == F.lit(as_day(shock))
    nodes = largest.join(best, ["time", "community"]).select(
        "time",
        "community",
        "community_rank",
        "node",
        "size",
        (F.sqrt("size") / VISUAL_SCALE).alias("visual_size"),
        is_shock.alias("is_shock"),
    )
    sources = nodes.select("time", F.col("node").alias("source"), "community")
    targets = nodes.select("time", F.col("node").alias("target"), "community")
    from_chosen = skewed_join(
        edges.select("time", "source", "target", "size"), sources, ["time", "source"], "inner"
    )
    inside = skewed_join(from_chosen, targets, ["time", "target", "community"], "inner").select(
        "time", "community", "source", "target", "size", (F.sqrt("size") / VISUAL_SCALE * 2).alias("visual_weight")
    )
    return Subgraph(nodes, inside)
