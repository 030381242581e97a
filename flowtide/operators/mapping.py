"""Token-to-protocol mapping as small tables: rev_map, token_map and id_info."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.values import sum_of_map_text
from flowtide.operators.aggregates import token_frequency
from flowtide.operators.similarity import similarity_matches
from flowtide.plans.skew import skewed_join


class Mapping(NamedTuple):
    rev_map: DataFrame
    token_map: DataFrame
    id_info: DataFrame


def with_total_tvls(protocols: DataFrame) -> DataFrame:
    """Add ``total_tvls``, the sum over the ``{chain: tvl}`` text of a protocol."""
    column = "currentChainTvls" if "currentChainTvls" in protocols.columns else "chainTvls"
    return protocols.withColumn("total_tvls", sum_of_map_text(column))


def _usable(text: Column, strict_text: bool) -> Column:
    usable = text.isNotNull() & (text != "-")
    # texts that stand for a missing value
    return usable if strict_text else usable & ~text.isin("None", "nan")


def reverse_map(ranked: DataFrame, strict_text: bool = False) -> DataFrame:
    """Symbol or asset token → protocol id. The protocol with the lowest TVL owns a shared symbol."""
    symbols = ranked.select("id", "total_tvls", F.explode(F.array("assetToken", "symbol")).alias("token"))
    owner = F.min_by("id", F.struct("total_tvls", "id"))
    return symbols.where(_usable(F.col("token"), strict_text)).groupBy("token").agg(owner.alias("id"))


def token_classes(facts: DataFrame, rev_map: DataFrame) -> DataFrame:
    """Every non-null token with its class, frequency and, for class ``MAP``, its owner."""
    owners = rev_map.select(F.col("token").alias("token_name"), F.col("id").alias("owner_id"))
    name = F.col("token_name")
    ladder = (
        F.when(F.col("owner_id").isNotNull(), "MAP")
        .when(name.contains("LP"), "LP")
        .when(name.contains("UNKNOWN"), "UNKNOWN")
        .when(name.contains("-"), "OTHER")
        .otherwise("PRIMARY")
    )
    frequencies = token_frequency(facts.where(name.isNotNull()), ordered=False)
    return frequencies.join(owners, "token_name", "left").select(
        "token_name", ladder.alias("class"), "frequency", "owner_id"
    )


def primary_tokens(classes: DataFrame) -> DataFrame:
    primary = classes.where(F.col("class") == "PRIMARY").select("token_name", "frequency")
    return primary.orderBy(F.desc("frequency"), "token_name")


def primary_owners(primary_map: DataFrame, ranked: DataFrame) -> DataFrame:
    """Manual overrides: token → id of the protocol of the given name with the highest TVL."""
    best = ranked.groupBy("name").agg(F.min_by("id", F.struct(-F.col("total_tvls"), "id")).alias("primary_id"))
    named = primary_map.select("token_name", F.col("protocol_name").alias("name"))
    return named.join(best, "name").select("token_name", "primary_id")


def rule_token_map(classes: DataFrame, owners: DataFrame) -> DataFrame:
    """Owner, manual override for PRIMARY, else the token itself (PRIMARY) or its class name."""
    is_primary = F.col("class") == "PRIMARY"
    default = F.when(is_primary, F.col("token_name")).otherwise(F.col("class"))
    mapped = F.coalesce("owner_id", F.when(is_primary, F.col("primary_id")), default)
    return classes.join(owners, "token_name", "left").select(
        "token_name", "class", "frequency", mapped.alias("mapped_id")
    )


def overlay_matches(token_map: DataFrame, matches: DataFrame) -> DataFrame:
    found = matches.select("token_name", F.col("id").alias("_match"))
    return token_map.join(found, "token_name", "left").select(
        "token_name", "class", "frequency", F.coalesce("_match", "mapped_id").alias("mapped_id")
    )


def id_info(protocols: DataFrame, category_map: DataFrame) -> DataFrame:
    """id → name and broad category; here a missing category does become ``Unknown``."""
    lookup = category_map.select(F.col("detailed").alias("category"), "broad")
    return protocols.join(lookup, "category", "left").select(
        "id", "name", F.coalesce("broad", F.lit("Unknown")).alias("category")
    )


def lookup_tokens(df: DataFrame, token_map: DataFrame) -> DataFrame:
    """Add ``token_id``; tokens without a mapping get NULL."""
    owners = token_map.select("token_name", F.col("mapped_id").alias("token_id"))
    return skewed_join(df, owners, ["token_name"])


def name_ids(df: DataFrame, info: DataFrame, column: str) -> DataFrame:
    """Replace an id column by the display name, else the id text, else ``None`` as a text."""
    names = info.select(F.col("id").alias(column), F.col("name").alias("_name"))
    joined = skewed_join(df, names, [column])
    return joined.withColumn(column, F.coalesce("_name", column, F.lit("None"))).select(*df.columns)


def update_mapping(
    facts: DataFrame,
    protocols: DataFrame,
    category_map: DataFrame,
    primary_map: DataFrame,
    threshold: float | None = None,
    text_columns: list[str] | None = None,
) -> Mapping:
    """All three tables; ``threshold`` turns the text-similarity overlay on."""
    ranked = with_total_tvls(protocols)
    rev_map = reverse_map(ranked)
    token_map = rule_token_map(token_classes(facts, rev_map), primary_owners(primary_map, ranked))
    if threshold is not None:
        matches = similarity_matches(token_map.select("token_name"), ranked, threshold, text_columns)
        token_map = overlay_matches(token_map, matches)
    return Mapping(rev_map, token_map, id_info(protocols, category_map))
