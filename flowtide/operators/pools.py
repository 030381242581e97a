"""Weekly TVL of liquidity pools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: pools shown by name, and the width of the accepted band in interquartile ranges
TOP_POOLS = 10
BAND = 1.5


def weekly_pool_tvl(pools: DataFrame, top: int = TOP_POOLS, ordered: bool = True) -> DataFrame:
    """Mean TVL per Monday week and category, in billions, without the weeks outside the quartile band.

    A category is the token pair of a pool among the ``top`` by all-time mean TVL (ties by pool id), else ``Other``.
    """
    means = pools.groupBy("pool_id").agg(F.avg("tvl_usd").alias("mean_tvl"))
    best = means.orderBy(F.desc_nulls_last("mean_tvl"), "pool_id").limit(top)
    flags = best.select("pool_id", F.lit(True).alias("is_top"))
    pair = F.concat("token0", F.lit("/"), "token1")
    category = F.when(F.col("is_top"), pair).otherwise(F.lit("Other"))
    weekly = (
        pools.join(flags, "pool_id", "left")
        .groupBy(
            F.trunc("date", "week").cast("timestamp_ntz").alias("date"),
            category.alias("pool_category"),
        )
        .agg(F.avg("tvl_usd").alias("avg_tvl_usd"))
    )
    # exact quartiles over one row per week and category
    quartiles = F.percentile("avg_tvl_usd", F.array(F.lit(0.25), F.lit(0.75)))
    quartiles = weekly.agg(quartiles.alias("q")).select("q").scalar()
    low, high = F.get(quartiles, F.lit(0)), F.get(quartiles, F.lit(1))
    band = BAND * (high - low)
    kept = weekly.where(F.col("avg_tvl_usd").between(low - band, high + band)).select(
        "date", "pool_category", (F.col("avg_tvl_usd") / 1e9).alias("tvl_usd_billions")
    )
    return kept.orderBy("date", "pool_category") if ordered else kept


def rank_pool_categories(weekly: DataFrame) -> DataFrame:
    means = weekly.groupBy("pool_category").agg(F.avg("tvl_usd_billions").alias("tvl_usd_billions"))
    return means.orderBy(F.desc_nulls_last("tvl_usd_billions"), "pool_category")
