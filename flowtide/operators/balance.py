"""Balance-sheet analysis: clean-up, per-token balances, rolling means.

The clean-up aggregates to one row per day and (type, liquidity, source, token), so the date-ordered windows
below run over a calendar's worth of rows per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.functions.calendar import utc_date
from flowtide.functions.values import to_number
from flowtide.plans.rolling import with_rolling_mean
from flowtide.plans.skew import expand_copies

# fixed values: how many of the largest asset rows mark outliers, the rolling window, the row types
LARGEST_ASSETS = 15
WINDOW_ROWS = 7
TYPES = ("asset", "liability", "equity")


def clean_balance_sheet(sheet: DataFrame, largest: int = LARGEST_ASSETS) -> DataFrame:
    """Parse numbers and dates, drop outlying asset rows, and sum by (type, liquidity, source, token, date).

    Outliers are asset rows whose date and whose token each occur among the ``largest`` asset rows by value (ties by
    token, then date). Unparseable numbers count as 0; rows with a missing key are dropped.
    """
    parsed = sheet.select(
        "type",
        "liquidity",
        "source",
        "token",
        utc_date(F.col("date")).alias("date_str"),
        to_number("amount").alias("amount"),
        to_number("usd_value").alias("usd_value"),
    )
    peak = (
        parsed.where(F.col("type") == "asset")
        .orderBy(F.desc_nulls_last("usd_value"), "token", "date_str")
        .limit(largest)
        .select("token", "date_str")
    )
    # at most `largest` rows each; the planner decides by size
    dates = peak.select("date_str").distinct().withColumn("_on_date", F.lit(True))
    tokens = peak.select("token").distinct().withColumn("_of_token", F.lit(True))
    flagged = parsed.join(dates, "date_str", "left").join(tokens, "token", "left")
    outlier = (F.col("type") == "asset") & F.col("_on_date") & F.col("_of_token")
    keys = ["type", "liquidity", "source", "token", "date_str"]
    zero = F.lit(0.0)
    return (
        flagged.where(~F.coalesce(outlier, F.lit(False)))
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("usd_value"), zero).alias("usd_value"),
            F.coalesce(F.sum("amount"), zero).alias("amount"),
        )
    )


def token_balances(clean: DataFrame, ordered: bool = True, folded: bool = True) -> DataFrame:
    """Asset minus liability per (date, token), missing sides as 0.

    Several asset and liability rows of one date and token (by liquidity and source) meet pairwise. Rows of equal
    values are folded before they meet, with the number of equal results in ``copies``; ``folded=False`` writes those out.
    """

    def side(kind: str) -> DataFrame:
        values = [F.col("amount").alias(f"{kind}_amount"), F.col("usd_value").alias(f"{kind}_usd_value")]
        return clean.where(F.col("type") == kind).groupBy("date_str", "token", *values).agg(F.count("*").alias(f"_{kind}_rows"))

    both = side("asset").join(side("liability"), ["date_str", "token"], "full_outer").fillna(0.0)
    one = F.lit(1).cast("bigint")
    balances = both.select(
        "date_str",
        "token",
        "asset_amount",
        "asset_usd_value",
        "liability_amount",
        "liability_usd_value",
        (F.col("asset_usd_value") - F.col("liability_usd_value")).alias("usd_value_balance"),
        (F.col("asset_amount") - F.col("liability_amount")).alias("amount_balance"),
        (F.greatest("_asset_rows", one) * F.greatest("_liability_rows", one)).alias("copies"),
    )
    if not folded:
        balances = expand_copies(balances)
    return balances.orderBy("token", "date_str") if ordered else balances


def _rolling_mean(column: str, window) -> Column:
    frame = window.rowsBetween(1 - WINDOW_ROWS, W.currentRow)
    return F.when(F.count(column).over(frame) == WINDOW_ROWS, F.avg(column).over(frame))


def balance_overview(clean: DataFrame) -> DataFrame:
    """Daily totals per type as columns, with 7-row means and their equity + liability sum."""
    daily = clean.groupBy("date_str").pivot("type", list(TYPES)).agg(F.sum("usd_value")).fillna(0.0, list(TYPES))
    by_date = W.partitionBy(F.lit(0)).orderBy("date_str")
    means = daily.withColumns({f"{t}_ma": _rolling_mean(t, by_date) for t in TYPES})
    return means.withColumn("equity+liability", F.col("equity_ma") + F.col("liability_ma"))


def token_moving_average(balances: DataFrame, token: str | None = None) -> DataFrame:
    """7-row mean of the value balance of one token, or of each token, over range slices that hand their last rows on; folded rows count each."""
    rows = balances if token is None else balances.where(F.col("token") == token)
    if "copies" in rows.columns:
        rows = expand_copies(rows)
    order = ["date_str", "asset_usd_value", "liability_usd_value", "asset_amount", "liability_amount"]
    return with_rolling_mean(rows, "token", order, "usd_value_balance", "moving_average", WINDOW_ROWS)


def area_series(overview: DataFrame) -> DataFrame:
    """Signed area series in long form: assets above zero, equity + liability and liability below."""
    signed = overview.select(
        "date_str",
        F.col("asset_ma").alias("asset"),
        (-F.col("equity+liability")).alias("equity"),
        (-F.col("liability_ma")).alias("liability"),
    )
    return signed.unpivot(["date_str"], ["asset", "equity", "liability"], "series", "value")
