"""Exact top-k by inner product: candidates in buckets of similar length, pruned by local thresholds.

A query's k-th best score over one block of the longest vectors bounds its final k-th score from below. For a bucket whose longest
vector is l, a candidate can reach the bound b only if its cosine reaches b / (|q| l): above one the whole
bucket drops out. A low local threshold is used on lengths (only vectors of at least b / |q|), a high one
on the query's largest coordinates (each confines a candidate's coordinate to a range). What is left is multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm.storage import stored

BUCKETS = 16
BLOCK = 8192
QUERY_BLOCK = 16384
FOCUS = 3
COORDINATE_FROM = 0.4
_SLACK = 1e-9


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, dim, norm, code): floor(scale * x) of every component as packed doubles.

    Left out: rows without id, null vectors, and vectors with a null or non-finite component. A component that only scaling
    makes infinite is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
            if not np.isfinite(flat).all():
                raise OverflowError(f"a component times {scale} is beyond the range of double")
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            norms = np.array([np.sqrt(np.sum(flat[e - s : e] ** 2)) for s, e in zip(sizes, ends, strict=True)])
            codes = [flat[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes.astype(np.int32)), pa.array(norms, pa.float64()), pa.array(codes, pa.binary())],
                ["vec_id", "dim", "norm", "code"],
            )

    x = F.col("v")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    given = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    given = given.where("vec_id is not null and v is not null").where(~bad)
    return given.mapInArrow(run, "vec_id bigint, dim int, norm double, code binary").distinct()


def _matrix(table: pa.Table) -> np.ndarray:
    rows = table.column("code").to_pylist()
    return np.frombuffer(b"".join(rows)).reshape(len(rows), -1) if rows else np.zeros((0, 0))


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products: doubles are exact below 2**53, beyond that integers are used, and Python's where long is too small.

    A product outside the range of long is an error, as in the SQL.
    """
    largest = np.abs(rows).max(initial=0) * np.abs(query).max(initial=0) * max(1, len(query))
    if largest < 2**53:
        return (rows @ query).astype(np.int64)
    if largest < 2**62:
        return rows.astype(np.int64) @ query.astype(np.int64)
    other = [int(x) for x in query]
    exact = [sum(int(x) * y for x, y in zip(row, other, strict=True)) for row in rows.tolist()]
    if any(not -(2**63) <= x < 2**63 for x in exact):
        raise OverflowError("a score is outside the range of long")
    return np.array(exact, np.int64)


class Bucket:
    """One block of candidates, longest first, with its coordinates sorted on demand."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, norms: np.ndarray):
        order = np.lexsort((ids, -norms))
        self.ids, self.rows, self.norms = ids[order], rows[order], norms[order]
        self.unit = self.rows / np.maximum(self.norms, 1e-300)[:, None]
        self.repeats = len(np.unique(ids)) < len(ids)
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.sorted[f] = order, self.unit[order, f]
        return self.sorted[f]

    def candidates(self, query: np.ndarray, norm: float, bound: float) -> np.ndarray:
        """Rows whose product with ``query`` can reach ``bound``."""
        if not (bound > 0 and norm > 0 and len(self.ids)):
            return np.arange(len(self.ids))
        shortest = bound / norm * (1 - _SLACK)
        long_enough = int(np.searchsorted(-self.norms, -shortest, side="right"))
        local = shortest / self.norms[0] if self.norms[0] else np.inf
        if not long_enough or local > 1 + _SLACK:
            return np.zeros(0, np.int64)
        if local < COORDINATE_FROM:
            return np.arange(long_enough)
        local = min(local, 1.0)
        unit = query / norm
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        hits = np.zeros(len(self.ids), np.int8)
        for f in focus:
            middle, room = unit[f] * local, np.sqrt(max(0.0, (1 - local**2) * (1 - unit[f] ** 2))) + 1e-7
            least = -1.1 if unit[f] <= -local else middle - room
            most = 1.1 if unit[f] >= local else middle + room
            order, values = self.coordinate(int(f))
            low, high = np.searchsorted(values, [least, most])
            hits[order[low:high]] += 1
        return np.flatnonzero(hits[:long_enough] == len(focus))


def check_range(stock: DataFrame, asked: DataFrame) -> None:
    """An error, if the lengths leave room for a score outside the range of long: so it depends on the data and on no pruning."""
    longest = [t.groupBy("dim").agg(F.max("norm").alias(n)) for t, n in ((stock, "a"), (asked, "b"))]
    if not longest[0].join(longest[1], "dim").where(F.col("a") * F.col("b") >= 2.0**63).isEmpty():
        raise OverflowError("a score may be outside the range of long")


def _best_of_each(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids in order, each once with its best score."""
    order = np.lexsort((-scores, ids))
    first = np.append(True, ids[order][1:] != ids[order][:-1])[: len(order)]
    return ids[order][first], scores[order][first]


def _best(query_ids, queries, norms, bounds, bucket: Bucket, k: int, names=None):
    """Up to k best (query, vector, score) of each query within a block, each id once; ties go to the smaller id.

    ``names`` stand for the queries in the result in place of their ids.
    """
    out = []
    for query_id, query, norm, bound, name in zip(query_ids, queries, norms, bounds, query_ids if names is None else names, strict=True):
        at = bucket.candidates(query, norm, bound)
        at = at[bucket.ids[at] != query_id]
        if not len(at):
            continue
        scores, ids = _products(bucket.rows[at], query), bucket.ids[at]
        if bucket.repeats:
            ids, scores = _best_of_each(ids, scores)
        if len(ids) > k:
            kth = np.partition(scores, -k)[-k]
            near = scores >= kth
            scores, ids = scores[near], ids[near]
        top = np.lexsort((ids, -scores))[:k]
        out.append((np.full(len(top), name), ids[top], scores[top]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors for each row of ``queries``, never itself.

    Both tables have vec_id and embedding. Nulls and non-finite components: see ``quantised``. Vectors meet only vectors of
    their own dimension. Scores are exact; vectors so long that a score might be outside the range of long are an error. Empty tables give no rows, further columns
    are not read. Equal rows count once; an id with several vectors scores by its best pair. Buckets
    are dealt out in blocks by a hash of the id, so vectors of one length, or copies of one vector, spread. Ties at
    the bound survive every pruning step.
    """
    stock = stored(quantised(vectors, scale))
    asked = stored(quantised(queries, scale))
    check_range(stock, asked)
    cuts = [i / BUCKETS for i in range(BUCKETS - 1, 0, -1)]
    limits = stock.groupBy("dim").agg(F.percentile_approx("norm", cuts).alias("limits"))
    bucketed = stock.join(limits, "dim").withColumn("bucket", F.size(F.filter("limits", lambda x: x > F.col("norm")))).drop("limits")
    sizes = stored(bucketed.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.max("norm").alias("longest")))
    entry = F.struct("bucket", "longest", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    buckets = sizes.groupBy("dim").agg(F.sort_array(F.collect_list(entry)).alias("buckets"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    plan = stored(buckets.join(blocks, "dim"))

    spread = F.xxhash64("vec_id")
    meta = F.filter("buckets", lambda b: b["bucket"] == F.col("bucket"))[0]
    dealt = bucketed.join(plan, "dim").withColumn("block", F.pmod(spread, meta["blocks"])).drop("buckets")
    wanted = asked.join(plan, "dim").withColumn("query_block", F.pmod(spread, F.col("query_blocks")))

    keys = ["dim", "bucket", "block", "query_block"]
    code = [F.col(c).cast("bigint") for c in keys[:3]]

    def first_bounds(asked_rows: pa.Table, stock_rows: pa.Table) -> pa.Table:
        ids, rows, norms = (asked_rows.column("vec_id").to_numpy(), _matrix(asked_rows), asked_rows.column("norm").to_numpy())
        low = np.full(len(ids), -np.inf)
        if len(ids) and stock_rows.num_rows:
            block = Bucket(stock_rows.column("vec_id").to_numpy(), _matrix(stock_rows), stock_rows.column("norm").to_numpy())
            # by row, because a query id may have several vectors too
            found, _, scores = _best(ids, rows, norms, low, block, k, np.arange(len(ids)))
            count = np.bincount(found, minlength=len(ids))
            least = np.full(len(ids), np.inf)
            np.minimum.at(least, found, scores)
            low = np.where(count >= k, least, -np.inf)
        return pa.table({"vec_id": ids, "code": asked_rows.column("code"), "bound": low})

    lead = F.col("buckets")[0]["bucket"].cast("bigint").alias("bucket")
    leading = wanted.select("dim", lead, F.col("query_block").cast("bigint").alias("query_block"), "vec_id", "norm", "code")
    # only the first block of the bucket with the longest vectors goes to all queries
    first = plan.select("dim", F.col("buckets")[0]["bucket"].alias("bucket"), "query_blocks")
    seeds = dealt.where("block = 0").drop("query_blocks").join(first, ["dim", "bucket"])
    seeds = seeds.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    at = ["dim", "bucket", "query_block"]
    seeds = seeds.select(*[F.col(c).cast("bigint") for c in at], "vec_id", "norm", "code")
    bounds = leading.groupBy(*at).cogroup(seeds.groupBy(*at)).applyInArrow(first_bounds, "vec_id bigint, code binary, bound double")
    bounds = stored(bounds)

    open_ = wanted.join(bounds, ["vec_id", "code"]).withColumn("b", F.explode("buckets"))
    # a bucket stays open unless its longest vector cannot reach the bound
    open_ = open_.where((F.col("bound") <= 0) | (F.col("b.longest") * F.col("norm") * (1 + _SLACK) >= F.col("bound")))
    open_ = open_.withColumn("bucket", F.col("b.bucket"))
    # what a block of queries asks for at least: a candidate goes to it only if its length can reach one of the bounds
    shortest = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm") * (1 - _SLACK)).otherwise(F.lit(0.0))
    asks = open_.groupBy("dim", "bucket", "query_block").agg(F.min(shortest).alias("floor"))
    asks = asks.groupBy("dim", "bucket").agg(F.collect_list(F.struct("query_block", "floor")).alias("asks"))
    copies = dealt.drop("query_blocks").join(stored(asks), ["dim", "bucket"])
    copies = copies.withColumn("query_block", F.explode(F.transform(F.filter("asks", lambda a: a["floor"] <= F.col("norm")), lambda a: a["query_block"])))
    copies = copies.select(*code, F.col("query_block").cast("bigint").alias("query_block"), "vec_id", "norm", "code")
    open_ = open_.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("b.blocks") - 1)))
    open_ = open_.select(*[F.col(c).cast("bigint") for c in keys], "vec_id", "norm", "code", "bound")

    def verify(asked_rows: pa.Table, stock_rows: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * 3
        if asked_rows.num_rows and stock_rows.num_rows:
            block = Bucket(stock_rows.column("vec_id").to_numpy(), _matrix(stock_rows), stock_rows.column("norm").to_numpy())
            columns = (asked_rows.column(c).to_numpy() for c in ("norm", "bound"))
            found = _best(asked_rows.column("vec_id").to_numpy(), _matrix(asked_rows), *columns, block, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    schema = "query_id bigint, vec_id bigint, score bigint"
    pairs = open_.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(verify, schema)
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
