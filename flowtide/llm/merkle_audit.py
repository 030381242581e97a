"""Merkle fixity audit of WARC replicas.

A record is hashed with its length. Records whose offsets fall into one range of ``leaf`` bytes form a node, ``fanout`` ranges form
a node of the next level, up to one root per file; a node's hash covers the hashes of its children in order
of offset. Replicas are compared at the roots; only the children of nodes that differ are compared next. A node has at
most ``fanout`` children, and a range holds as many records as fit into it, so no group grows with a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm.storage import stored

LEAF_BYTES = 1 << 18
FANOUT = 16


def record_hash(payload: Column) -> Column:
    """SHA-256 of a record's bytes; a record without bytes has a hash of its own."""
    return F.coalesce(F.sha2(payload.cast("binary"), 256), F.lit("missing payload"))


def leaves(records: DataFrame) -> DataFrame:
    """(file, offset, length, hash) of ``records(file, offset, payload)``; rows without file or offset take no part."""
    placed = records.where("file is not null and offset is not null")
    return placed.select(
        "file", F.col("offset").cast("bigint").alias("offset"),
        F.coalesce(F.octet_length(F.col("payload").cast("binary")), F.lit(0)).cast("bigint").alias("length"),
        record_hash(F.col("payload")).alias("hash"),
    )


def _joined(parts: Column) -> Column:
    lines = F.transform(F.sort_array(F.collect_list(parts)), lambda s: F.concat_ws(" ", *[s[f"c{i}"] for i in range(4)]))
    return F.sha2(F.concat_ws("\n", lines), 256)


def tree(leaf_rows: DataFrame, leaf: int = LEAF_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of nodes (file, node, hash, children) from the offset ranges up to one node per file, each stored.

    Equal records are counted first, so a record that stands there very often is one child with its number.
    """
    counted = leaf_rows.groupBy("file", "offset", "length", "hash").agg(F.count("*").alias("n"))
    parts = F.struct(F.col("offset").alias("c0"), F.col("length").alias("c1"), F.col("hash").alias("c2"), F.col("n").alias("c3"))
    grouped = counted.groupBy("file", F.floor(F.col("offset") / leaf).alias("node"))
    levels = [stored(grouped.agg(_joined(parts).alias("hash"), F.sum("n").alias("children")))]
    while levels[-1].agg(F.max("node")).first()[0]:
        parts = F.struct(F.col("node").alias("c0"), F.col("children").alias("c1"), F.col("hash").alias("c2"), F.lit(1).alias("c3"))
        grouped = levels[-1].groupBy("file", F.floor(F.col("node") / fanout).alias("node"))
        levels.append(stored(grouped.agg(_joined(parts).alias("hash"), F.count("*").alias("children"))))
    return levels


def _differing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hashes differ or that only one side has."""
    both = left.select(*keys, F.col("hash").alias("a")).join(right.select(*keys, F.col("hash").alias("b")), keys, "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)


def audit(left: DataFrame, right: DataFrame, leaf: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """``audit_leaves`` of two replicas ``(file, offset, payload)``. Other columns are not read, whatever their names."""
    return audit_leaves(leaves(left), leaves(right), leaf, fanout)


def audit_leaves(left: DataFrame, right: DataFrame, leaf: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Damage between two replicas: (file, offset, length_left, length_right, hash_left, hash_right, kind).

    ``kind`` is changed, missing (only left), extra (only right) or repeated (the record stands a different number of times).
    Equal rows at one offset count by their number; different ones are told apart by their hashes. Two empty
    replicas, or equal ones, give no rows. The replicas are tables of (file, offset, length, hash).
    """
    rows = [stored(r.select("file", "offset", "length", "hash")) for r in (left, right)]
    trees = [tree(r, leaf, fanout) for r in rows]
    height = max(map(len, trees))
    for levels in trees:  # the lower tree goes on as single chains
        while len(levels) < height:
            levels.append(levels[-1])
    suspects = None
    for level in range(height - 1, -1, -1):
        pair = [levels[level] for levels in trees]
        if suspects is not None:
            above = [t[level].withColumn("parent", F.floor(F.col("node") / fanout)) for t in trees]
            pair = [t.join(suspects, (t["file"] == suspects["_file"]) & (t["parent"] == suspects["_node"]), "left_semi") for t in above]
        suspects = stored(_differing(*pair, ["file", "node"])).toDF("_file", "_node")
    pair = [r.withColumn("node", F.floor(F.col("offset") / leaf)) for r in rows]
    near = [t.join(suspects, (t["file"] == suspects["_file"]) & (t["node"] == suspects["_node"]), "left_semi") for t in pair]
    counted = [t.groupBy("file", "offset", "length", "hash").agg(F.count("*").alias("n")) for t in near]
    # what both sides have equally often is sound; the rest meets by offset
    on = ["file", "offset", "length", "hash"]
    a, b = (t.withColumnRenamed("n", f"n_{s}") for t, s in zip(counted, "ab", strict=True))
    odd = a.join(b, on, "full_outer").where("coalesce(n_a, 0) <> coalesce(n_b, 0)")
    repeated = odd.where("n_a is not null and n_b is not null").select(
        "file", "offset", F.col("length").alias("length_left"), F.col("length").alias("length_right"),
        F.col("hash").alias("hash_left"), F.col("hash").alias("hash_right"), F.lit("repeated").alias("kind"),
    )
    order = Window.partitionBy("file", "offset").orderBy("hash", "length")
    sides = [
        odd.where(f"n_{s} is not null and n_{o} is null").select(
            "file", "offset", F.row_number().over(order).alias("place"), F.struct("hash", "length").alias(s))
        for s, o in (("a", "b"), ("b", "a"))
    ]
    met = sides[0].join(sides[1], ["file", "offset", "place"], "full_outer").select(
        "file", "offset", F.col("a.length").alias("length_left"), F.col("b.length").alias("length_right"),
        F.col("a.hash").alias("hash_left"), F.col("b.hash").alias("hash_right"),
        F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed").alias("kind"),
    )
    return met.unionByName(repeated)


def _payloads(pages: DataFrame, per_file: int) -> DataFrame:
    """(page_id, file, payload) of every page with an id."""
    body = F.coalesce(F.col("html"), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col("url"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )
    return pages.where("page_id is not null").select("page_id", F.floor(F.col("page_id") / per_file).alias("file"), record.alias("payload"))


def _with_offsets(records: DataFrame) -> DataFrame:
    """``records(file, page_id, length, hash, ...)``, each once, with the offset in its file."""
    before = Window.partitionBy("file").orderBy("page_id", "hash").rowsBetween(Window.unboundedPreceding, -1)
    return records.distinct().withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint"))


def _measured(payload: Column, suffix: str = "") -> list[Column]:
    return [F.octet_length(payload).cast("bigint").alias(f"length{suffix}"), record_hash(payload).alias(f"hash{suffix}")]


def warc_records(pages: DataFrame, per_file: int = 512) -> DataFrame:
    """``pages(page_id, url, html)`` as WARC response records: (file, offset, payload, page_id).

    A file takes the pages of ``per_file`` neighbouring ids, in order of id and of the record's hash, so a file's running offset is a window
    over a bounded group. Pages without an id have no place in a file and are left out; equal rows become one record. Further columns
    are not read, whatever their names; an empty table gives no records.
    """
    made = _payloads(pages, per_file)
    return _with_offsets(made.select("file", "page_id", *_measured(F.col("payload")), "payload")).select("file", "offset", "payload", "page_id")


def warc_leaves(pages: DataFrame, changed: Column | None = None, per_file: int = 512) -> DataFrame:
    """(file, offset, page_id, length, hash) of the records of ``warc_records``; bodies are hashed where they are read, and not shuffled.

    ``changed`` is an expression over page_id and payload, for a replica with the same offsets: its length and hash follow
    as ``length_changed`` and ``hash_changed``. Nulls and repeats as in ``warc_records``.
    """
    made = _payloads(pages, per_file)
    columns = _measured(F.col("payload")) + ([] if changed is None else _measured(changed, "_changed"))
    return _with_offsets(made.select("file", "page_id", *columns))
