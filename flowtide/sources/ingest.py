"""From nested source documents to fact rows, and the incremental filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from flowtide.functions.values import last_entry_per_key
from flowtide.plans.skew import skewed_join
from flowtide.schemas import as_facts


def normalise_headers(headers: DataFrame) -> DataFrame:
    """Nested columns to JSON text, ``type`` to ``default``; missing values stay NULL."""
    nested = [f.name for f in headers.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    return headers.withColumns({**{n: F.to_json(n) for n in nested}, "type": F.lit("default")})


def flatten_tvl(documents: DataFrame) -> DataFrame:
    """Fact rows of ``id, chainTvls: {chain: {tokensInUsd, tokens}}`` documents.

    The value and the quantity list of a chain are paired by position up to the shorter one. Date and tokens
    come from the value side; a token without a quantity, or an amount that is no number, has 0. Repeated keys keep their last value.
    """
    chains = documents.select("id", F.explode(last_entry_per_key(F.col("chainTvls"))).alias("chain_name", "lists"))
    values, quantities = F.col("lists.tokensInUsd"), F.col("lists.tokens")
    shared = F.least(F.size(values), F.size(quantities))
    pairs = F.slice(F.arrays_zip(values.alias("usd"), quantities.alias("qty")), F.lit(1), shared)
    dates = (
        chains.where(values.isNotNull() & quantities.isNotNull())
        .select("id", "chain_name", F.explode(pairs).alias("pair"))
        .select(
            "id",
            "chain_name",
            F.col("pair.usd.date").alias("date"),
            last_entry_per_key(F.col("pair.usd.tokens")).alias("usd"),
            last_entry_per_key(F.col("pair.qty.tokens")).alias("qty"),
        )
    )
    tokens = dates.select("id", "chain_name", "date", "qty", F.explode("usd").alias("token_name", "value"))
    zero = F.lit(0.0)
    return as_facts(
        tokens.withColumns(
            {
                "quantity": F.coalesce(F.try_element_at("qty", F.col("token_name")).try_cast("double"), zero),
                "value_usd": F.coalesce(F.col("value").try_cast("double"), zero),
            }
        )
    )


def incremental_rows(incoming: DataFrame, latest: DataFrame) -> DataFrame:
    """Incoming rows newer than the stored maximum of their (id, chain, token), or without one.

    ``latest`` has one row per key. Keys with a NULL part never match, so their rows pass.
    """
    joined = skewed_join(
        incoming, latest, ["id", "chain_name", "token_name"]
    )
    is_new = F.col("latest_date").isNull() | (F.col("date") > F.col("latest_date"))
    return joined.where(is_new).select(*incoming.columns)
