"""Joins and expansions that keep one hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def skewed_join(
    big: DataFrame, small: DataFrame, keys: list[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys``, where one key may hold a large part of ``big``.

    Both sides reach the join through plain shuffles, so Spark's adaptive execution splits the partition of a hot key and
    copies only the matching part of ``small`` to its splits; where it finds ``small`` below the broadcast threshold,
    nothing is shuffled. No row is copied on suspicion. With ``null_safe`` NULL keys are equal.
    """
    if not null_safe:
        return big.join(small, keys, how)
    renamed = small.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition &= big[key].eqNullSafe(renamed[f"_right_{key}"])
    return big.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def expand_copies(df: DataFrame, copies: str = "copies", block: int = 1024) -> DataFrame:
    """Repeat each row as often as its ``copies`` column says, and drop that column.

    Rows with up to ``block`` copies, nearly all of them, are repeated where they are. The others are cut into blocks, in two
    levels so that no array grows with the number, and the blocks are shuffled before they are written out.
    """
    columns = [c for c in df.columns if c != copies]
    n = F.col(copies).cast("bigint")
    zero, one, size = (F.lit(v).cast("bigint") for v in (0, 1, block))

    def numbers(first: Column, last: Column, name: str, rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.explode(F.sequence(first, last)))

    few = numbers(one, F.col(copies).cast("bigint"), "_copy", df.where((n > 0) & (n <= block))).select(*columns)
    many = df.where(n > block)
    outer = numbers(zero, F.floor((n - 1) / (block * block)).cast("bigint"), "_outer", many)
    inner = numbers(zero, F.least(size, F.ceil((n - F.col("_outer") * block * block) / block).cast("bigint")) - 1, "_inner", outer)
    left = n - F.col("_outer") * block * block - F.col("_inner") * block
    blocks = inner.withColumn("_size", F.least(size, left)).repartition(*columns, "_outer", "_inner")
    return few.unionByName(numbers(one, F.col("_size"), "_copy", blocks).select(*columns))
