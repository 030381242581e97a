"""Means over the last rows of groups that are too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.session import ensure_checkpoints


def with_rolling_mean(df: DataFrame, group: str, order: list[str], value: str, name: str, rows: int) -> DataFrame:
    """Add ``name``: the mean of ``value`` over a row and the ``rows - 1`` before it in its group; NULL where they are fewer or one is NULL.

    Rows are range-partitioned by group and order, so a group with a third of all rows covers many tasks, and kept in a checkpoint, so
    the cut points stay. Every slice is handed its halo, the last ``rows - 1`` rows before it, which may come from several slices
    where some are short. Rows with equal order are taken by all columns. NULL groups are one group.
    """
    ensure_checkpoints(df.sparkSession)
    columns = df.columns
    keys = [*order, *[c for c in columns if c not in order and c != group]]
    sliced = df.repartitionByRange(F.col(group), *[F.col(c) for c in keys]).withColumn("_slice", F.spark_partition_id()).checkpoint()
    in_slice = W.partitionBy(group, "_slice")
    sizes = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_rows"))
    by_group = W.partitionBy(group).orderBy("_slice")
    before = F.coalesce(F.sum("_rows").over(by_group.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # a slice has at least one row, so a halo comes from the next ``rows - 1`` slices at most
    place = F.row_number().over(by_group)
    slices = sizes.select(F.col(group).alias("_g"), F.col("_slice").alias("_s"), place.alias("_place"), before.alias("_from"), "_rows").checkpoint()
    back = F.row_number().over(in_slice.orderBy(*[F.col(c).desc() for c in keys]))
    tails = sliced.withColumn("_back", back).where(F.col("_back") < rows)
    placed = tails.join(slices, tails[group].eqNullSafe(slices["_g"]) & (F.col("_slice") == F.col("_s"))).drop("_g", "_s")
    handed = placed.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(rows - 1))))
    nexts = slices.select(F.col("_g").alias("_ng"), F.col("_s").alias("_to"), F.col("_place").alias("_np"), F.col("_from").alias("_until"))
    aimed = handed.join(nexts, handed[group].eqNullSafe(F.col("_ng")) & (F.col("_place") + F.col("_step") == F.col("_np")))
    # rows from this one (included) to where the slice begins
    near = F.col("_until") - (F.col("_from") + F.col("_rows") - F.col("_back")) < rows
    halo = aimed.where(near).select(*columns, F.col("_to").alias("_slice"), F.lit(True).alias("_halo"))
    both = sliced.withColumn("_halo", F.lit(False)).unionByName(halo)
    frame = in_slice.orderBy(*[F.col(c) for c in keys]).rowsBetween(1 - rows, W.currentRow)
    mean = F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))
    return both.withColumn(name, mean).where(~F.col("_halo")).select(*columns, name)

