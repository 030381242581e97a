"""Mixing sources to target weights by Poisson replication.

A source with target weight w gets the mean repetition rate w * total / (sum of the weights) / (its documents), so the expected mix
has the wanted weights and the wanted size. Each document draws its number of copies from the Poisson distribution
with its source's rate, by inverting the distribution function at a uniform number hashed from its id. The copies are
then shuffled globally by a hash of id and copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.storage import free_name, from_row, stored, whole_row

#: Above this mean a source is split into equal parts, so that exp(-mean) stays far from zero.
PART = 32.0


def uniform(seed: str, *columns: str) -> Column:
    """52 bits of MD5 as a number in [0, 1): the same on every engine and in every run."""
    text = F.concat_ws("/", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weight: Column | None = None, total: float | None = None) -> DataFrame:
    """(source, n, rate) for every source, null included.

    ``weight`` is an expression over ``source`` and its number of documents ``n``; by default the square root of ``n``, which
    raises small sources. ``total`` is the expected size of the mix (default: as many documents as there are).
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    weighted = counts.withColumn("w", (F.sqrt("n") if weight is None else weight).cast("double"))
    sums = weighted.agg(F.sum("w").alias("sum_w"), F.sum("n").cast("double").alias("all_n"))
    size = F.col("all_n") if total is None else F.lit(float(total))
    both = weighted.join(F.broadcast(sums))  # one row
    return both.select("source", "n", (F.col("w") * size / F.col("sum_w") / F.col("n")).alias("rate"))


def poisson(rate: Column, u: Column) -> Column:
    """The smallest k whose distribution function exceeds ``u``, for rates up to ``PART``."""
    first = F.exp(-rate)
    start = F.struct(F.lit(0).alias("k"), first.alias("p"), first.alias("f"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        more = s["f"] <= u
        return F.struct(
            F.when(more, k).otherwise(s["k"]).alias("k"), p.alias("p"), F.when(more, s["f"] + p).otherwise(s["f"]).alias("f")
        )

    # far beyond the mean the terms vanish: 52-bit uniforms never reach this bound
    top = F.ceil(rate * 3 + 40).cast("int")
    return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda s: s["k"])


def mix(docs: DataFrame, weight: Column | None = None, total: float | None = None, seed: str = "mix") -> DataFrame:
    """``docs`` repeated to the target weights and in global random order; all columns stay, and three follow.

    ``_copy`` numbers a document's copies, ``_order`` is a copy's random number in [0, 1), ``_rate`` the rate of the source; where ``docs`` has a
    column of such a name, the new one gets another underscore. Copies are dealt to partitions by their random number and sorted
    by it there, which needs no sampling pass. Nulls: a null source is a source of its own; a null doc_id draws like any other
    id. Rows with equal doc_id draw equal counts. An empty table gives an empty mix. Texts are not read.
    """
    found = stored(rates(docs, weight, total)).select(F.col("source").alias("_source"), F.col("rate").alias("_rate"))
    given = docs.select(whole_row(docs), "source", "doc_id")
    joined = given.join(found, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    parts = F.greatest(F.ceil(F.col("_rate") / PART), F.lit(1)).cast("int")
    one = poisson(F.col("_rate") / parts, F.col("_u"))
    drawn = joined.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    drawn = drawn.withColumn("_u", uniform(seed, "doc_id", "_part")).withColumn("_k", one).where("_k > 0")
    copies = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    copies = copies.withColumn("_copy", (F.col("_part") * 100_000 + F.col("_copy")).cast("bigint"))
    placed = copies.withColumn("_order", uniform(f"{seed}-order", "doc_id", "_copy"))
    dealt = placed.select("_row", "doc_id", "_copy", "_order", "_rate").repartition("_order")
    ordered = dealt.sortWithinPartitions("_order", F.col("doc_id").asc_nulls_first(), "_copy")
    added = [F.col(c).alias(free_name(c, docs.columns)) for c in ("_copy", "_order", "_rate")]
    return ordered.select(*from_row(ordered, docs.columns), *added)
