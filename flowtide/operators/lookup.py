"""Lookups, projections and filters over facts and protocols."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.plans.skew import skewed_join


def facts_of_protocols(facts: DataFrame, ids: Iterable[str]) -> DataFrame:
    """Facts of the listed protocols; a list of any length is a table of ids."""
    table = facts.sparkSession.createDataFrame([(i,) for i in sorted(set(ids))], "id string")
    return skewed_join(facts, table, ["id"], "left_semi").select(*facts.columns)


def protocol_info(protocols: DataFrame, identifier: str | Iterable[str | None]) -> DataFrame:
    """Protocols whose id, or lower-cased name, equals one of the lower-cased identifiers; ``None`` is ignored."""
    given = [identifier] if isinstance(identifier, str) else list(identifier)
    wanted = [str(i).lower() for i in given if i is not None]
    lead = ["id", "name", "slug"]
    rest = [c for c in protocols.columns if c not in lead]
    matches = F.col("id").isin(wanted) | F.lower("name").isin(wanted)
    return protocols.where(matches).select(*lead, *rest)


def unique_token_names(facts: DataFrame) -> DataFrame:
    return facts.select("token_name").distinct()


def tokens_by_chain(facts: DataFrame, chains: Iterable[str] | None = None, ordered: bool = True) -> DataFrame:
    """Distinct non-blank (token, chain) pairs; no or empty ``chains`` means every chain."""
    rows = facts.where(F.col("token_name") != "")
    wanted = list(chains or [])
    if wanted:
        rows = rows.where(F.col("chain_name").isin(wanted))
    pairs = rows.select("token_name", "chain_name").distinct()
    if not ordered:
        return pairs
    return pairs.orderBy(F.asc_nulls_last("chain_name"), "token_name")


def _slugs_by_tvl(protocols: DataFrame, desc: bool) -> DataFrame:
    best = protocols.groupBy("slug").agg(F.max("tvl").alias("max_tvl"))
    rank = F.desc_nulls_last("max_tvl") if desc else F.asc_nulls_last("max_tvl")
    return best.orderBy(rank, F.asc_nulls_last("slug"))


def protocol_slugs(protocols: DataFrame, desc: bool = True) -> DataFrame:
    """Slugs ranked by their largest TVL; ties in slug order."""
    return _slugs_by_tvl(protocols, desc).select("slug")


def first_protocol_slugs(protocols: DataFrame, limit: int | None = None, desc: bool = True) -> DataFrame:
    ranked = _slugs_by_tvl(protocols, desc)
    return (ranked if limit is None else ranked.limit(limit)).select("slug")


def category_map_frame(spark: SparkSession, mapping: Mapping[str, Iterable[str]]) -> DataFrame:
    """``{broad: [detailed, …]}`` as a table; the last broad name given for a detailed one counts."""
    broad_of = {detailed: broad for broad, names in mapping.items() for detailed in names}
    return spark.createDataFrame([(b, d) for d, b in broad_of.items()], "broad string, detailed string")


def category_to_type(df: DataFrame, category_map: DataFrame) -> DataFrame:
    """Overwrite ``type`` by the broad category; unmapped becomes ``Unknown`` but NULL stays NULL."""
    lookup = category_map.select(F.col("detailed").alias("category"), F.col("broad").alias("_broad"))
    broad = F.when(F.col("category").isNotNull(), F.coalesce("_broad", F.lit("Unknown")))
    return skewed_join(df, lookup, ["category"]).withColumn("type", broad).select(*df.columns)
