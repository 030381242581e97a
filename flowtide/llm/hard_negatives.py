"""Hard-negative mining by segment summaries.

A vector is stored with the mean and the deviation of each of its segments. Over a segment of m places a product of two vectors is m times
the product of the means, plus or minus the product of the deviations at most; the sum over the segments bounds
the whole product from both sides. Halves of segments bound it closer. A candidate is refined from one segment to the finest ones only while its
bounds leave open whether it counts, and what stays open is multiplied out exactly.

Anchors are a stated query set and meet all other vectors in blocks. A first pass finds an anchor's positives among the blocks of its
own label, a second its negatives among the others. A vector is sent to a block of anchors only if its length allows a score
that one of them asks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm.norm_topk import _products as exact_products
from flowtide.llm.norm_topk import check_range
from flowtide.llm.storage import stored

BLOCK = 8192
ANCHOR_BLOCK = 16384
#: Segments of a vector at each level of refinement.
LEVELS = (1, 4, 16)
_SLACK = 1e-9


def _edges(dim: int, segments: int) -> np.ndarray:
    """Borders of the segments; those of a coarser level are borders of a finer one."""
    return np.unique(np.arange(segments + 1) * dim // segments)


def summaries(rows: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean times the root of the segment's size, and root of the sum of squared deviations, for every row and segment.

    Products of the former are m times the product of the means.
    """
    edges = _edges(rows.shape[1], segments)
    if len(edges) < 2:
        return np.zeros((len(rows), 0)), np.zeros((len(rows), 0))
    sizes = np.diff(edges)
    mean = np.add.reduceat(rows, edges[:-1], axis=1) / sizes
    rest = rows - np.repeat(mean, sizes, axis=1)
    return mean * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))


def prepared(vectors: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """(vec_id, label, dim, norm, code, stats), equal rows once.

    ``code`` are floor(scale * x) of all components, ``stats`` the means and deviations of all levels, both as packed doubles. Left out: rows
    without id or label, null vectors and those with a null or non-finite component. A component that only scaling makes infinite
    is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
            if not np.isfinite(flat).all():
                raise OverflowError(f"a component times {scale} is beyond the range of double")
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            codes, stats, norms = [], [], []
            for size, end in zip(sizes, ends, strict=True):
                row = flat[None, end - size : end]
                codes.append(row.tobytes())
                stats.append(np.concatenate([x for level in LEVELS for x in summaries(row, level)], axis=1).tobytes())
                norms.append(float(np.sqrt(np.sum(row * row))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(norms, pa.float64()),
                 pa.array(codes, pa.binary()), pa.array(stats, pa.binary())],
                ["vec_id", "label", "dim", "norm", "code", "stats"],
            )

    x = F.col("v")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    given = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    given = given.where("vec_id is not null and label is not null and v is not null").where(~bad).distinct()
    return given.mapInArrow(run, "vec_id bigint, label bigint, dim int, norm double, code binary, stats binary")


class Block:
    """Vectors with the summaries of each level, as matrices."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        self.ids = table.column("vec_id").to_numpy()
        self.rows = _packed(table.column("code"), n)
        stats = _packed(table.column("stats"), n)
        self.levels, at = [], 0
        for level in LEVELS:
            width = max(len(_edges(self.rows.shape[1], level)) - 1, 0)
            self.levels.append((stats[:, at : at + width], stats[:, at + width : at + 2 * width]))
            at += 2 * width


def _packed(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(n, -1) if n else np.zeros((0, 0))


def _band(mean: np.ndarray, spread: np.ndarray, means: np.ndarray, spreads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of one row's products with many, widened by what rounding may take."""
    middle, room = means @ mean, spreads @ spread
    room = room + _SLACK * (np.abs(means) @ np.abs(mean) + room)
    return middle - room, middle + room


def _kth(values: np.ndarray, k: int):
    """The k-th largest; less than anything, if there are fewer."""
    return np.partition(values, -k)[-k] if len(values) >= k else -np.inf


def nearest(anchors: Block, i: int, block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best products with anchor i, and of all that tie with the k-th."""
    at = np.flatnonzero(block.ids != anchors.ids[i])
    for level in range(len(LEVELS)):
        mean, spread = (m[i] for m in anchors.levels[level])
        low, high = _band(mean, spread, *(m[at] for m in block.levels[level]))
        at = at[high >= _kth(low, k)]
    scores = exact_products(block.rows[at], anchors.rows[i])
    near = scores >= _kth(scores, k) if len(scores) > k else np.ones(len(scores), bool)
    return at[near], scores[near]


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        near = np.arange(len(ids))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def least_negative(positive: int, share: tuple[int, int]) -> int:
    """The smallest whole score of at least ``share`` of the positive's, exactly."""
    return -((-share[0] * positive) // share[1])


def negatives(anchors: Block, i: int, block: Block, positives: list[int], k: int, share: tuple[int, int]):
    """For each positive score: rows and scores of the k best products with anchor i in its band.

    A row is open for a band while its bounds meet it, and unless k rows that are surely inside are surely better.
    """
    at = np.flatnonzero(block.ids != anchors.ids[i])
    bands = [(least_negative(p, share), p) for p in positives]
    for level in range(len(LEVELS)):
        mean, spread = (m[i] for m in anchors.levels[level])
        low, high = _band(mean, spread, *(m[at] for m in block.levels[level]))
        open_ = np.zeros(len(at), bool)
        for least, most in bands:
            inside = (low >= least) & (high <= most)
            open_ |= (high >= least) & (low <= most) & (high >= _kth(low[inside], k))
        at = at[open_]
    scores = exact_products(block.rows[at], anchors.rows[i])
    out = []
    for least, most in bands:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        out.append(inside[_first(block.ids[at[inside]], scores[inside], k)])
    return [(at[which], scores[which]) for which in out]


def _dealt(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows in blocks of their label, by a hash of the id, so a frequent label has many blocks."""
    return rows.join(sizes, ["dim", "label"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks")).drop("blocks")


def _apart(rows: DataFrame) -> DataFrame:
    """Columns of their own, for a join with a table of the same origin."""
    return rows.toDF(*rows.columns)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    scale: int = 256,
    positives: int = 5,
    per_positive: int = 5,
    share: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``vectors(vec_id, embedding, ...)``.

    ``anchors`` is a condition over vec_id, ``label`` an expression over the columns. A row's score is its inner product with
    the anchor after ``floor(scale * x)``, higher first, ties by vec_id. An anchor's positives are its first ``positives`` rows of the
    same label; for each, the first ``per_positive`` rows of other labels whose score lies between ``share`` of the positive's and it.

    Scores are exact; vectors so long that a score might be outside the range of long are an error. Rows that take no part: see ``prepared``. Vectors
    meet only vectors of their own length; rows with the anchor's own id are no partners of it. Equal rows count once,
    different rows of one id are rows of their own. Empty tables, and anchors without partners, give no rows.
    Further columns are not read, whatever their names.
    """
    stock = stored(prepared(vectors, label, scale))
    count = stock.groupBy("dim", "label").agg(F.count("*").alias("n"))
    sizes = stored(count.select("dim", "label", F.ceil(F.col("n") / BLOCK).cast("bigint").alias("blocks")))
    asked = stock.where(anchors)
    check_range(stock, asked)
    tables = asked.groupBy("dim").agg(F.ceil(F.count("*") / ANCHOR_BLOCK).cast("bigint").alias("tables"))
    asked = asked.join(tables, "dim").withColumn("anchor_block", F.pmod(F.xxhash64("vec_id"), "tables")).drop("tables")
    asked = stored(asked.withColumn("anchor", F.sha2(F.concat_ws(":", "vec_id", "label", F.hex("code")), 256)))
    dealt = stored(_dealt(stock, sizes))
    dim = F.col("dim").cast("bigint").alias("dim")
    keys = ["dim", "label", "block", "anchor_block"]
    vector = ["vec_id", "code", "stats"]

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            one, other = Block(left), Block(right)
            for i, name in enumerate(left.column("anchor").to_pylist()):
                at, scores = nearest(one, i, other, positives)
                top = _first(other.ids[at], scores, positives)
                found += [(name, int(p), int(s)) for p, s in zip(other.ids[at[top]], scores[top], strict=True)]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "positive_id", "positive_score"])

    own = asked.join(sizes, ["dim", "label"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select(dim, "label", F.col("block").cast("bigint").alias("block"), "anchor_block", "anchor", *vector)
    wanted = asked.select("dim", "label", "anchor_block").distinct()
    near = dealt.join(wanted, ["dim", "label"]).select(dim, "label", F.col("block").cast("bigint").alias("block"), "anchor_block", *vector)
    pairs = own.groupBy(*keys).cogroup(_apart(near).groupBy(*keys)).applyInArrow(find_positives, "anchor string, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    chosen = stored(pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place"))

    # below a positive score of zero the band is empty; at zero only zero is inside
    targets = chosen.where("positive_score >= 0").groupBy("anchor").agg(
        F.collect_set("positive_score").alias("scores"), F.min("positive_score").alias("least"))
    second = asked.withColumnRenamed("label", "own").join(targets, "anchor")
    floor = F.when(F.col("norm") > 0, F.col("least").cast("double") * share[0] / share[1] / F.col("norm")).otherwise(F.lit(0.0))
    second = stored(second.withColumn("floor", floor * (1 - _SLACK)))

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            one, other = Block(left), Block(right)
            names, lists = left.column("anchor").to_pylist(), left.column("scores").to_pylist()
            for i, (name, scores) in enumerate(zip(names, lists, strict=True)):
                for p, (at, values) in zip(scores, negatives(one, i, other, scores, per_positive, share), strict=True):
                    found += [(name, p, int(n), int(s)) for n, s in zip(other.ids[at], values, strict=True)]
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "positive_score", "negative_id", "negative_score"])

    longest = dealt.groupBy("dim", "label", "block").agg(F.max("norm").alias("longest"))
    there = second.join(longest, "dim").where((F.col("label") != F.col("own")) & (F.col("longest") >= F.col("floor")))
    there = there.select(dim, "label", F.col("block").cast("bigint").alias("block"), "anchor_block", "anchor", "scores", *vector)
    open_ = second.groupBy("dim", "anchor_block").agg(F.min("floor").alias("floor"), F.collect_set("own").alias("owns"))
    # a block of anchors that all have the candidate's label does not ask for it
    asks = (F.col("norm") >= F.col("floor")) & ((F.size("owns") > 1) | ~F.array_contains("owns", F.col("label")))
    far = dealt.join(open_, "dim").where(asks).select(dim, "label", F.col("block").cast("bigint").alias("block"), "anchor_block", *vector)
    schema = "anchor string, positive_score bigint, negative_id bigint, negative_score bigint"
    mined = there.groupBy(*keys).cogroup(_apart(far).groupBy(*keys)).applyInArrow(find_negatives, schema)
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    mined = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_positive)
    named = chosen.join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.join(mined, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
