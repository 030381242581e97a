"""Position changes as directed value flows between protocols and token owners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.operators.mapping import lookup_tokens


def value_flows(changes: DataFrame, token_map: DataFrame) -> DataFrame:
    """One flow row per change row.

    A falling value flows from the protocol to the owner of the token, any other (also an
    unknown) change the other way. Opening quantity and value stay with the protocol's side. ``period`` and
    ``copies`` are carried along when present.
    """
    rows = lookup_tokens(changes, token_map)
    falls = F.col("usd_change") < 0
    rises = F.col("usd_change") >= 0
    carried = [c for c in ("period", "copies") if c in changes.columns]
    return rows.select(
        *carried,
        F.when(falls, F.col("id")).otherwise(F.col("token_id")).alias("from_node"),
        F.when(falls, F.col("token_id")).otherwise(F.col("id")).alias("to_node"),
        "chain_name",
        F.when(falls, F.col("qty")).alias("qty_from"),
        F.when(rises, F.col("qty")).alias("qty_to"),
        F.when(falls, F.col("usd")).alias("usd_from"),
        F.when(rises, F.col("usd")).alias("usd_to"),
        "token_name",
        F.abs("qty_change").alias("qty_flow"),
        F.abs("usd_change").alias("usd_flow"),
    )
