"""Row filters shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chain_filter(mode: str = "exclude_borrowed", column: str = "chain_name") -> Column:
    """``exclude_borrowed``, ``only_borrowed``, ``all``, or the name of one chain."""
    chain = F.col(column)
    if mode == "all":
        return F.lit(True)
    if mode == "exclude_borrowed":
        return ~chain.like("%borrowed%")
    if mode == "only_borrowed":
        return chain.like("%borrowed%")
    return chain == mode


def epoch_range(low: int, high: int, column: str = "date") -> Column:
    """``low <= column < high`` as plain comparisons, which reach the parquet reader."""
    return (F.col(column) >= low) & (F.col(column) < high)
