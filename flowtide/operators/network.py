"""Value-flow networks: nodes and net links with their token composition.

Every function takes flow rows. When they carry a ``period`` column there is one network per period,
all computed in the same job; when they carry ``copies`` a row counts that many times. Nodes and links are
kept flat, ``(id, token, amount)`` and ``(source, target, token, amount)``; the nested document form
is put together only at the end, for sinks.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.operators.changes import historical_changes
from flowtide.operators.flows import value_flows
from flowtide.operators.mapping import name_ids
from flowtide.plans.skew import skewed_join
from flowtide.session import ensure_checkpoints

#: Tokens of one line of a document.
DOCUMENT_TOKENS = 1024
# sorts before every id, so that an unmapped (NULL) end has a place in the order of a pair
_NO_NODE = "\u0000"


def _period(df: DataFrame) -> list[str]:
    return [c for c in ("period",) if c in df.columns]


def _weighted(flows: DataFrame, amount: Column) -> Column:
    return amount * F.col("copies") if "copies" in flows.columns else amount


def _amounts_by_node(flows: DataFrame) -> DataFrame:
    """Opening value per (node, token); NULL where the node only owns the token."""
    ends = F.array(
        F.struct(F.col("from_node").alias("id"), _weighted(flows, F.col("usd_from")).alias("amount")),
        F.struct(F.col("to_node").alias("id"), _weighted(flows, F.col("usd_to")).alias("amount")),
    )
    period = _period(flows)
    sides = flows.select(*period, F.col("token_name").alias("token"), F.explode(ends).alias("end"))
    return (
        sides.select(*period, F.col("end.id").alias("id"), "token", F.col("end.amount").alias("amount"))
        .groupBy(*period, "id", "token")
        .agg(F.sum("amount").alias("amount"))
    )


def node_ids(flows: DataFrame) -> DataFrame:
    ends = F.explode(F.array("from_node", "to_node")).alias("id")
    return flows.select(*_period(flows), ends).distinct()


def node_composition(flows: DataFrame) -> DataFrame:
    """Opening value per (node, token)."""
    return _amounts_by_node(flows).where(F.col("amount").isNotNull())


def node_sizes(flows: DataFrame) -> DataFrame:
    """Total opening value per node; 0 for mere token owners and for the unmapped node."""
    size = F.when(F.col("id").isNotNull(), F.coalesce("amount", F.lit(0.0))).otherwise(F.lit(0.0))
    return _amounts_by_node(flows).groupBy(*_period(flows), "id").agg(F.sum(size).alias("size"))


def canonical_links(flows: DataFrame) -> DataFrame:
    """Net flow per (source, target, token) with source < target; negative where it runs from target to source."""
    period = _period(flows)
    start = F.coalesce("from_node", F.lit(_NO_NODE))
    end = F.coalesce("to_node", F.lit(_NO_NODE))
    forward = start < end
    flow = _weighted(flows, F.col("usd_flow"))
    return (
        flows.select(
            *period,
            F.when(forward, F.col("from_node")).otherwise(F.col("to_node")).alias("source"),
            F.when(forward, F.col("to_node")).otherwise(F.col("from_node")).alias("target"),
            F.col("token_name").alias("token"),
            F.when(forward, flow).otherwise(-flow).alias("flow"),
        )
        .groupBy(*period, "source", "target", "token")
        .agg(F.coalesce(F.sum("flow"), F.lit(0.0)).alias("amount"))
    )


def _net(canonical: DataFrame) -> DataFrame:
    period = _period(canonical)
    return canonical.groupBy(*period, "source", "target").agg(F.sum("amount").alias("net"))


def _in_flow_direction(df: DataFrame) -> dict[str, Column]:
    against = F.col("net") < 0
    return {
        "source": F.when(against, F.col("target")).otherwise(F.col("source")),
        "target": F.when(against, F.col("source")).otherwise(F.col("target")),
    }


def links(flows: DataFrame) -> DataFrame:
    """One link per unordered pair, pointing the way of the net flow; ``size`` is never negative."""
    net = _net(canonical_links(flows))
    ends = _in_flow_direction(net)
    # adding 0 turns a negative zero into zero
    size = (F.abs("net") + F.lit(0.0)).alias("size")
    return net.select(*_period(flows), ends["source"].alias("source"), ends["target"].alias("target"), size)


def link_composition(flows: DataFrame) -> DataFrame:
    """Flow per token along each link; negative for tokens that move against the net flow."""
    period = _period(flows)
    canonical = canonical_links(flows)
    both = skewed_join(canonical, _net(canonical), [*period, "source", "target"], "inner", null_safe=True)
    ends = _in_flow_direction(both)
    amount = F.when(F.col("net") < 0, -F.col("amount")).otherwise(F.col("amount"))
    return both.select(
        *period, ends["source"].alias("source"), ends["target"].alias("target"), "token", amount.alias("amount")
    )


def _nested(composition: DataFrame, keys: list[str]) -> DataFrame:
    entries = F.sort_array(F.collect_list(F.struct("token", "amount")))
    return composition.groupBy(*keys).agg(entries.alias("composition"))


def network_nodes(flows: DataFrame) -> DataFrame:
    """Document form of the nodes: ``[period], id, size, composition`` (one entry per distinct token)."""
    keys = [*_period(flows), "id"]
    amounts = _amounts_by_node(flows)
    held = F.when(F.col("amount").isNotNull(), F.struct("token", "amount"))
    size = F.when(F.col("id").isNotNull(), F.coalesce("amount", F.lit(0.0))).otherwise(F.lit(0.0))
    return amounts.groupBy(*keys).agg(
        F.sum(size).alias("size"), F.sort_array(F.collect_list(held)).alias("composition")
    )


def network_links(flows: DataFrame) -> DataFrame:
    """Document form of the links: ``[period], source, target, size, composition``."""
    keys = [*_period(flows), "source", "target"]
    nested = _nested(link_composition(flows), keys)
    size = F.abs(F.aggregate("composition", F.lit(0.0), lambda acc, e: acc + e["amount"])) + F.lit(0.0)
    return nested.select(*keys, size.alias("size"), "composition")


def _chunked(composition: DataFrame, keys: list[str], tokens: int) -> DataFrame:
    """``keys, chunk, composition`` with at most ``tokens`` entries a row.

    Entries are range-partitioned by key and token and numbered in that order, kept in a checkpoint; a chunk is a run of numbers, so one
    key's tokens cover as many rows, and as many tasks, as they need.
    """
    ensure_checkpoints(composition.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in [*keys, "token"]]
    placed = composition.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    entry = F.struct(F.coalesce("token", F.lit("null")), "amount")
    chunks = placed.groupBy(*keys, F.floor(F.col("_at") / tokens).alias("chunk"))
    return chunks.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("composition"))


def network_document(flows: DataFrame, nested: bool = False, tokens: int = DOCUMENT_TOKENS) -> DataFrame:
    """Nodes and links as JSON lines ``[period], part, json``.

    A line of part ``nodes`` or ``links`` has a node or link with its size; its composition, a token → amount object, follows in lines of part
    ``node_tokens`` or ``link_tokens`` that repeat its ends and hold at most ``tokens`` tokens each (``chunk`` tells them apart). So no
    cell grows with a node. ``nested=True`` puts the whole composition into the one line instead, for
    networks whose nodes have few tokens.
    """
    period = _period(flows)
    null_fields = {"ignoreNullFields": "false"}

    def lines(rows: DataFrame, part: str, *fields) -> DataFrame:
        return rows.select(*period, F.lit(part).alias("part"), F.to_json(F.struct(*fields), null_fields).alias("json"))

    if nested:
        as_map = F.map_from_entries(
            F.transform("composition", lambda e: F.struct(F.coalesce(e["token"], F.lit("null")), e["amount"]))
        ).alias("composition")
        nodes = lines(network_nodes(flows), "nodes", "id", "size", as_map)
        return nodes.unionByName(lines(network_links(flows), "links", "source", "target", "size", as_map))
    ends = ["source", "target"]
    # read four times below, so written once
    ensure_checkpoints(flows.sparkSession)
    flows = flows.checkpoint()
    held = _chunked(node_composition(flows), [*period, "id"], tokens)
    carried = _chunked(link_composition(flows), [*period, *ends], tokens)
    parts = [
        lines(node_sizes(flows), "nodes", "id", "size"), lines(held, "node_tokens", "id", "chunk", "composition"),
        lines(links(flows), "links", *ends, "size"), lines(carried, "link_tokens", *ends, "chunk", "composition"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def historical_flows(
    facts: DataFrame,
    protocols: DataFrame,
    token_map: DataFrame,
    granularity: str,
    start_date: str | date,
    unique: bool = False,
) -> DataFrame:
    changes = historical_changes(facts, protocols, granularity, start_date, unique=unique, folded=True)
    return value_flows(changes, token_map)


def historical_edges(flows: DataFrame, info: DataFrame, threshold: float | None = None) -> DataFrame:
    """Flat links of every period with display names: ``time, source, target, size``; ``size > threshold``."""
    edges = links(flows).withColumnRenamed("period", "time")
    if threshold is not None:
        edges = edges.where(F.col("size") > threshold)
    sources = name_ids(edges, info, "source")
    return name_ids(sources, info, "target").select("time", "source", "target", "size")


def historical_nodes(flows: DataFrame, info: DataFrame, threshold: float | None = None) -> DataFrame:
    """Flat nodes of every period: ``time, id, size, type``; a node without info is named ``Unknown``."""
    nodes = node_sizes(flows).withColumnRenamed("period", "time")
    if threshold is not None:
        nodes = nodes.where(F.col("size") > threshold)
    known = info.select("id", "name", "category")
    unknown = F.lit("Unknown")
    return skewed_join(nodes, known, ["id"]).select(
        "time",
        F.coalesce("name", unknown).alias("id"),
        "size",
        F.coalesce("category", unknown).alias("type"),
    )
