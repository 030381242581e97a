"""Ranks and running totals of groups that are too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.session import ensure_checkpoints


def with_running_totals(df: DataFrame, group: str, order: list[Column], value: str) -> DataFrame:
    """Add ``row_number``, ``running_total`` and ``group_total`` of ``value`` within ``group``.

    The rows are range-partitioned by group and order, so a large group (or a large tie) covers many tasks, and
    kept in a checkpoint, so the cut points cannot move between the two reads that follow: one adds up
    every slice, the other numbers the rows of a slice and adds what lies before it. There are at most as many
    slices as shuffle partitions and groups together.
    """
    ensure_checkpoints(df.sparkSession)
    sliced = df.repartitionByRange(F.col(group), *order).withColumn("_slice", F.spark_partition_id()).checkpoint()
    slices = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_rows"), F.sum(value).alias("_sum"))
    by_group = W.partitionBy(group)
    before = by_group.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = slices.select(
        group,
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_sum_before"),
        F.sum("_sum").over(by_group).alias("group_total"),
    )
    in_slice = W.partitionBy(group, "_slice").orderBy(*order)
    so_far = F.sum(value).over(in_slice.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        sliced.withColumns({"_rank": F.row_number().over(in_slice), "_so_far": F.coalesce(so_far, F.lit(0.0))})
        .join(offsets, [group, "_slice"])
        .select(
            *df.columns,
            (F.col("_rows_before") + F.col("_rank")).alias("row_number"),
            (F.col("_sum_before") + F.col("_so_far")).alias("running_total"),
            "group_total",
        )
    )
