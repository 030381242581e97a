"""First and last observation of a key, the shape behind every period-over-period change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a place packed below a date.
_BITS = 28
_ENDS = ("_first_low", "_first_high", "_last_low", "_last_high")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with a place in 28 bits: rows that one task reads follow each other, and tasks start at scattered places."""
    start = F.spark_partition_id().cast("bigint") * 0x9E3779B1
    place = (F.monotonically_increasing_id() + start).bitwiseAND(F.lit((1 << _BITS) - 1).cast("bigint"))
    far = 1 << (62 - _BITS)
    near = F.greatest(F.least(F.col("date"), F.lit(far - 1).cast("bigint")), F.lit(-far).cast("bigint"))
    return rows.withColumn("_place", place).withColumn("_day", F.shiftleft(near, _BITS))


def _extremes() -> list[Column]:
    """Smallest and largest place at the first date and at the last one, each packed with its date into one long."""
    up = F.col("_day") + F.col("_place")
    down = F.col("_day") + (F.lit((1 << _BITS) - 1).cast("bigint") - F.col("_place"))
    found = (F.min(up), F.min(down), F.max(down), F.max(up))
    return [value.alias(name) for value, name in zip(found, _ENDS, strict=True)]


def _checked(keys: list[str]) -> Column:
    """True, or an error where the first or the last date of a key has more than one row.

    A single row has one place, so that the place counted up and the place counted down add up to the top of the bits.
    """
    top = F.lit((1 << _BITS) - 1).cast("bigint")
    broken = F.lit(False)
    for low, high in (_ENDS[:2], _ENDS[2:]):
        broken |= F.col(low).bitwiseAND(top) + F.col(high).bitwiseAND(top) != top
    shown = F.concat_ws(", ", *[F.col(key).cast("string") for key in keys])
    error = F.raise_error(F.concat(F.lit("unique=True, but a first or last date has several rows: "), shown))
    return F.when(broken, error.cast("boolean")).otherwise(F.lit(True))


def first_last_pairs(rows: DataFrame, keys: list[str], min_rows: int = 1, unique: bool = False) -> DataFrame:
    """Pair the rows at the smallest ``date`` of a key with the rows at its largest.

    Returns ``keys, first_date, last_date, qty, usd, last_qty, last_usd, copies``. When several rows share
    a key and a boundary date, every first row meets every last row; equal pairs are not repeated
    but counted in ``copies``. Keys with fewer than ``min_rows`` rows, or a NULL part, are dropped.

    ``unique=True`` promises at most one row per key and date. It is a single hash aggregate with map-side
    combine, so a key holding a third of all rows costs one partial row per task. The same aggregate notices a boundary
    date that two rows share, whatever their values: that is an error, raised when the result is computed. It goes by the rows'
    places, so one repeat in 2^28 may pass unseen; dates from the year 2514 on count as one.
    The general form first folds equal rows (also map-side), then looks the two boundary dates up by
    (key, date), which spreads the rows of a hot key over its dates.
    """
    present = rows.dropna(subset=keys)
    if unique:
        ends = (
            _placed(present)
            .groupBy(*keys)
            .agg(
                F.min("date").alias("first_date"),
                F.max("date").alias("last_date"),
                F.min_by("quantity", "date").alias("qty"),
                F.min_by("value_usd", "date").alias("usd"),
                F.max_by("quantity", "date").alias("last_qty"),
                F.max_by("value_usd", "date").alias("last_usd"),
                F.count("*").alias("_rows"),
                *_extremes(),
            )
        )
        return (
            ends.where(_checked(keys) & (F.col("_rows") >= min_rows))
            .drop("_rows", *_ENDS)
            .withColumn("copies", F.lit(1).cast("bigint"))
        )
    folded = present.groupBy(*keys, "date", "quantity", "value_usd").agg(F.count("*").alias("_copies"))
    bounds = (
        folded.groupBy(*keys)
        .agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("_copies").alias("_rows"))
        .where(F.col("_rows") >= min_rows)
        .drop("_rows")
    )
    firsts = folded.select(
        *keys,
        F.col("date").alias("first_date"),
        F.col("quantity").alias("qty"),
        F.col("value_usd").alias("usd"),
        F.col("_copies").alias("_first_copies"),
    )
    lasts = folded.select(
        *keys,
        F.col("date").alias("last_date"),
        F.col("quantity").alias("last_qty"),
        F.col("value_usd").alias("last_usd"),
        F.col("_copies").alias("_last_copies"),
    )
    return (
        bounds.join(firsts, [*keys, "first_date"])
        .join(lasts, [*keys, "last_date"])
        .select(
            *keys,
            "first_date",
            "last_date",
            "qty",
            "usd",
            "last_qty",
            "last_usd",
            (F.col("_first_copies") * F.col("_last_copies")).alias("copies"),
        )
    )
