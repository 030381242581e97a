"""SimHash near-duplicates by meeting in the middle: balls around fingerprints instead of pairs of documents.

Two fingerprints that differ in three bits have different parity. So those of odd parity emit the ball of radius one,
those of even parity the ball of radius two, and both meet in a common variant. Of the three differing
bits two lie in the same half of the word; the larger ball therefore only needs pairs of flips within one half.
Fingerprints of equal parity differ in two bits at most and meet in a single flip of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.components import components
from flowtide.llm.storage import discard, from_row, stored, whole_row

_BLOCK = 1 << 15
#: A half with more seeds is dealt out by whole variants.
HOT_HALF = 1 << 14


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned SimHash of a UTF-8 text over word shingles; zero without words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for low in range(0, n, _BLOCK):
        high = min(low + _BLOCK, n)
        spans = zip(starts[low:high].tolist(), ends[low + shingle - 1 : high + shingle - 1].tolist(), strict=True)
        hashes = np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in spans), np.uint64, high - low)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, row_hash, fingerprint long): one row per document; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            values = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["doc_id", "row_hash", "fingerprint"]
            )

    given = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, row_hash bigint, fingerprint bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(sets) -> Column:
    return F.lit(np.array([_signed(sum(1 << b for b in bits)) for bits in sets], np.int64))


#: A variant is dealt out by the half that the larger ball leaves alone: side 0 keeps the upper half, side 1 the lower.
_LOWER, _UPPER = range(32), range(32, 64)
_KEPT, _FREE = (_UPPER, _LOWER), (_LOWER, _UPPER)


def _half(word: Column, side: int) -> Column:
    return F.shiftrightunsigned(word, 32) if side == 0 else word.bitwiseAND(F.lit((1 << 32) - 1))


def _seeds(prints: DataFrame, side: int, kind: str) -> DataFrame:
    """(side, half, base, fingerprint, kind): what a task needs to spell a ball out behind the shuffle.

    ``one`` are single flips in the kept half, each with a half of its own; ``other`` stands for all single flips in the free half,
    ``wide`` for the fingerprint itself and all pairs of flips in the free half.
    """
    fp = F.col("fingerprint")
    if kind == "one":
        prints = prints.withColumn("mask", F.explode(_masks([(b,) for b in _KEPT[side]])))
        base = fp.bitwiseXOR(F.col("mask"))
    else:
        base = fp
    return prints.select(F.lit(side).alias("side"), _half(base, side).alias("half"), base.alias("base"), "fingerprint", F.lit(kind).alias("kind"))


def _spelled(seeds: DataFrame, wide: bool) -> DataFrame:
    """(side, half, variant, fingerprint) of all seeds."""
    def free(size: int) -> list[Column]:
        return [_masks(combinations(_FREE[side], size)) for side in (0, 1)]

    side = F.col("side")
    none = F.array(F.lit(0).cast("bigint"))
    single = F.when(side == 0, free(1)[0]).otherwise(free(1)[1])
    pairs = F.when(side == 0, F.concat(none, free(2)[0])).otherwise(free(2)[1]) if wide else none
    masks = F.when(F.col("kind") == "one", none).when(F.col("kind") == "other", single).otherwise(pairs)
    flips = seeds.select("side", "half", "base", "fingerprint", F.explode(masks).alias("mask"))
    return flips.select("side", "half", F.col("base").bitwiseXOR(F.col("mask")).alias("variant"), "fingerprint")


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (u, v) between distinct fingerprints that give the same groups as all pairs within ``max_bits``.

    The members of a variant are linked to its smallest single-flip member, not to each other: a variant with
    very many members makes as many links. Every link is verified by its bit distance. All variants of a ball that share the
    half it leaves alone go through the shuffle as one row and are spelled out behind it; where very many fingerprints share
    a half, theirs are spelled out before it, so that half spreads over as many tasks as it has variants.
    """
    if max_bits not in (2, 3):
        raise ValueError("max_bits must be 2 or 3")
    odd = F.bit_count("fingerprint") % 2 == 1
    singles = _seeds(prints, 0, "one").union(_seeds(prints, 0, "other"))
    singles = singles.union(_seeds(prints.where(odd), 1, "one")).union(_seeds(prints.where(odd), 1, "other"))
    wide = _seeds(prints.where(~odd), 0, "wide")
    if max_bits == 3:
        wide = wide.union(_seeds(prints.where(~odd), 1, "wide"))
    everything = singles.union(wide)
    halves = ["side", "half"]
    crowded = everything.groupBy(*halves).agg(F.count("*").alias("n")).where(F.col("n") > HOT_HALF).select(*halves)
    places: list[str] = []
    crowded = stored(crowded, places)

    def met(how: str, deal) -> DataFrame:
        first = _spelled(deal(singles.join(crowded, halves, how)), False)
        hubs = first.groupBy(*halves, "variant").agg(F.min("fingerprint").alias("hub"), F.count("*").alias("members"))
        # an odd variant has single flips of even fingerprints only: it needs two of them
        hubs = hubs.where((F.bit_count("variant") % 2 == 0) | (F.col("members") > 1)).drop("members")
        emitted = _spelled(deal(everything.join(crowded, halves, how)), max_bits == 3)
        close = emitted.join(hubs, [*halves, "variant"]).where("fingerprint <> hub")
        close = close.where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("hub"))) <= max_bits)
        return close.select(F.col("fingerprint").alias("u"), F.col("hub").alias("v")).distinct()

    with _partial_keys(prints.sparkSession):
        # rows that are dealt out by (side, half) need no second shuffle to be joined by (side, half, variant)
        plain = stored(met("left_anti", lambda seeds: seeds.repartition(*halves)))
    spread = stored(met("left_semi", lambda seeds: seeds))
    discard(places)
    return plain.union(spread).distinct()


@contextmanager
def _partial_keys(spark) -> Iterator[None]:
    """Joins planned and run within may use a partitioning by some of their keys; the session's setting comes back."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, row_hash, fingerprint, component_id, root) for every document; ``root`` is the group's smallest fingerprint.

    Nulls: a null text is an empty one, and all empty texts share fingerprint zero. A null ``doc_id`` takes part
    but never names a group, unless the group has no other. Repeated rows stay rows of one group. An empty table gives no rows.
    Further columns of ``docs`` are not read.
    """
    marked = stored(fingerprints(docs, shingle))
    prints = marked.select("fingerprint").distinct()
    roots = stored(components(links(prints, max_bits)))
    rooted = marked.join(roots, marked["fingerprint"] == roots["node"], "left").select(
        "doc_id", "row_hash", "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )
    # stored, so that a root with very many documents is a join that Spark can split
    names = stored(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return rooted.join(names, "root").select("doc_id", "row_hash", "fingerprint", "component_id", "root")


def keep_one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each group; all columns stay, whatever their names. An empty table gives no rows.

    It is the one with the smallest doc_id, then the smallest text hash; one without doc_id stays only if no other has one.
    """
    groups = stored(simhash_groups(docs, shingle, max_bits))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_hash")
    heads = groups.groupBy("root").agg(F.min(order).alias("head")).select("head.doc_id", "head.row_hash")
    heads = heads.toDF("_keep_id", "_keep_hash")
    hashed = docs.select(whole_row(docs), "doc_id", F.xxhash64("text").alias("row_hash"))
    on = F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("row_hash") == F.col("_keep_hash"))
    kept = hashed.join(heads, on, "left_semi").dropDuplicates(["doc_id", "row_hash"])
    return kept.select(*from_row(kept, docs.columns))
