"""The benchmark tables seen as the engine's tables, for Spark and, as CTEs, for the SQL oracle."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.operators.mapping import Mapping, update_mapping
from flowtide.session import shared_dir
from flowtide.sources.tables import load_or_build_mapping


def _epoch(column: str):
    return F.unix_date(F.to_date(column)).cast("bigint") * 86_400


@dataclass
class Tables:
    spark: SparkSession
    folder: str
    _raw: dict[str, DataFrame] = field(default_factory=dict)
    made: dict[str, DataFrame] = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def _positions(self, token) -> DataFrame:
        chain = F.when(F.col("l_returnflag") == "R", F.concat("l_linestatus", F.lit("-borrowed")))
        return self.raw("lineitem").join(self.raw("part"), F.col("p_partkey") == F.col("l_partkey")).select(
            F.col("l_suppkey").cast("string").alias("id"),
            F.coalesce(chain, "l_linestatus").alias("chain_name"),
            _epoch("l_shipdate").alias("date"),
            token.alias("token_name"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("value_usd"),
        )

    @cached_property
    def positions(self) -> DataFrame:
        """Line items as positions; (id, chain, token, date) repeats."""
        return self._positions(F.col("p_type"))

    @cached_property
    def facts(self) -> DataFrame:
        """``positions`` added up, unique on (id, chain, token, date)."""
        return self.unique(self.positions)

    @cached_property
    def tagged_facts(self) -> DataFrame:
        """``facts`` with pool, unknown and wrapped tokens among the names."""
        size = F.col("p_size") % 7
        token = (
            F.when(size == 1, F.concat("p_type", F.lit("-LP")))
            .when(size == 2, F.concat(F.lit("UNKNOWN ("), "p_brand", F.lit(")")))
            .when(size == 3, F.concat("p_type", F.lit("-"), "p_brand"))
            .otherwise(F.col("p_type"))
        )
        return self.unique(self._positions(token))

    @staticmethod
    def unique(positions: DataFrame, *more: str) -> DataFrame:
        """Positions added up; ``more`` are columns that depend on the key."""
        return positions.groupBy(*more, "id", "chain_name", "date", "token_name").agg(
            F.round(F.sum("quantity"), 2).alias("quantity"), F.round(F.sum("value_usd"), 2).alias("value_usd")
        )

    @cached_property
    def protocols(self) -> DataFrame:
        key = F.col("s_suppkey")
        symbols = ["STANDARD", "LARGE", "SMALL", "ECONOMY", "-", None, "MEDIUM", "MEDIUM"]
        symbol = F.get(F.array(*[F.lit(s) for s in symbols]), (key % 8).cast("int"))
        cents = F.round(F.col("s_acctbal") * 100).cast("bigint").cast("string")
        tvls = F.concat(F.lit("{'Ethereum': "), key.cast("string"), F.lit(", 'Polygon': "), cents, F.lit("}"))
        return self.raw("supplier").join(self.raw("nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(
            key.cast("string").alias("id"),
            F.col("s_name").alias("name"),
            F.lower("s_name").alias("slug"),
            F.col("s_acctbal").alias("tvl"),
            F.col("n_name").alias("category"),
            F.lit("default").alias("type"),
            symbol.alias("symbol"),
            F.when(key % 3 == 0, "LARGE").otherwise("-").alias("assetToken"),
            tvls.alias("currentChainTvls"),
        )

    @cached_property
    def category_map(self) -> DataFrame:
        named = self.raw("nation").join(self.raw("region"), F.col("r_regionkey") == F.col("n_regionkey"))
        return named.where(F.col("r_name") != "MIDDLE EAST").select(
            F.col("r_name").alias("broad"), F.col("n_name").alias("detailed")
        )

    @cached_property
    def primary_map(self) -> DataFrame:
        return self.spark.range(1).select(
            F.lit("PROMO").alias("token_name"), F.lit("Supplier#000000005").alias("protocol_name")
        )

    @cached_property
    def mapping(self) -> Mapping:
        """Built once per session and folder, then read from its saved tables, as a user would."""
        name = hashlib.md5(self.folder.encode()).hexdigest()
        place = f"{shared_dir(self.spark)}/flowtide-mapping/{self.spark.sparkContext.applicationId}/{name}"
        return load_or_build_mapping(
            self.spark, place, lambda: update_mapping(self.positions, self.protocols, self.category_map, self.primary_map)
        )

    @cached_property
    def pools(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").cast("string").alias("pool_id"),
            F.to_date("ts").alias("date"),
            F.concat(F.lit("T"), (F.col("user_id") % 7).cast("string")).alias("token0"),
            F.concat(F.lit("U"), (F.col("user_id") % 5).cast("string")).alias("token1"),
            F.col("value").alias("tvl_usd"),
        )

    @cached_property
    def balance_sheet(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type").isin("view", "click"), "asset")
            .when(F.col("event_type").isin("purchase", "signup"), "liability")
            .otherwise("equity")
        )
        value = F.col("value").cast("string")
        return self.raw("events").select(
            kind.alias("type"),
            F.concat(F.lit("v"), (F.col("event_id") % 2).cast("string")).alias("liquidity"),
            F.lit("s").alias("source"),
            F.concat(F.lit("T"), (F.col("user_id") % 8).cast("string")).alias("token"),
            _epoch("ts").alias("date"),
            F.when(F.col("event_id") % 97 == 0, "bad").otherwise(value).alias("amount"),
            value.alias("usd_value"),
        )


_EPOCH = "cast(epoch(date_trunc('day', {})) as bigint)"

_POSITIONS = f"""
    select cast(l_suppkey as varchar) id,
           case when l_returnflag = 'R' then concat(l_linestatus, '-borrowed') else l_linestatus end chain_name,
           {_EPOCH.format("l_shipdate")} date, {{token}} token_name,
           l_quantity quantity, l_extendedprice value_usd
    from lineitem join part on p_partkey = l_partkey"""

_TAGGED = """case p_size % 7 when 1 then concat(p_type, '-LP') when 2 then concat('UNKNOWN (', p_brand, ')')
                             when 3 then concat(p_type, '-', p_brand) else p_type end"""

_UNIQUE = """
    select id, chain_name, date, token_name, round(sum(quantity), 2) quantity, round(sum(value_usd), 2) value_usd
    from {} group by 1, 2, 3, 4"""

CTES = {
    "positions": _POSITIONS.format(token="p_type"),
    "facts": _UNIQUE.format("positions"),
    "tagged_positions": _POSITIONS.format(token=_TAGGED),
    "tagged_facts": _UNIQUE.format("tagged_positions"),
    "protocols": """
    select cast(s_suppkey as varchar) id, s_name name, lower(s_name) slug, s_acctbal tvl, n_name category, 'default' type,
           case s_suppkey % 8 when 0 then 'STANDARD' when 1 then 'LARGE' when 2 then 'SMALL' when 3 then 'ECONOMY'
                when 4 then '-' when 5 then null else 'MEDIUM' end symbol,
           case when s_suppkey % 3 = 0 then 'LARGE' else '-' end assetToken,
           cast(s_suppkey + cast(round(s_acctbal * 100) as bigint) as double) total_tvls
    from supplier join nation on n_nationkey = s_nationkey""",
    "category_map": """
    select r_name broad, n_name detailed from nation join region on r_regionkey = n_regionkey
    where r_name <> 'MIDDLE EAST'""",
    "primary_map": "select 'PROMO' token_name, 'Supplier#000000005' protocol_name",
    "pools": """
    select cast(user_id as varchar) pool_id, cast(ts as date) date, concat('T', cast(user_id % 7 as varchar)) token0,
           concat('U', cast(user_id % 5 as varchar)) token1, value tvl_usd
    from events""",
    "bsheet": f"""
    select case when event_type in ('view', 'click') then 'asset'
                when event_type in ('purchase', 'signup') then 'liability' else 'equity' end type,
           concat('v', cast(event_id % 2 as varchar)) liquidity, 's' source,
           concat('T', cast(user_id % 8 as varchar)) token, {_EPOCH.format("ts")} date,
           case when event_id % 97 = 0 then null else value end amount, value usd_value
    from events""",
}


def with_ctes(body: str, **more: str) -> str:
    """``body`` preceded by the adapter views it (or one of ``more``) uses."""
    ctes = {**CTES, **more}
    clauses = ",\n".join(f"{name} as ({text})" for name, text in ctes.items())
    return f"with {clauses}\n{body}"
