"""Connected components of a link table, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.storage import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to its smallest one."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; the root is the smallest node that can be reached.

    Each round is a grouped minimum and a join with it, so no list of neighbours is formed and a node with
    very many links is a skewed join that Spark splits. The rounds end when the edges are those of the round before; each is
    written to the shared folder, and removed when the next one is there.
    """
    places: list[str] = []
    edges = stored(edges.where("u <> v").select("u", "v").distinct(), places)
    count = edges.count()
    while count:
        large = _large_star(edges).where("u <> v").distinct()
        after = stored(_small_star(large).where("u <> v").distinct(), places)
        before, count = count, after.count()
        done = before == count and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = after
        discard([places.pop(0)])
        if done:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v")).distinct()
