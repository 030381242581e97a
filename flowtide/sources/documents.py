"""JSON documents of any layout as texts: one after the other, in arrays, pretty-printed, on one line or over many.

A file is read in pieces that end at ``}``, wherever its line ends are, so a huge file splits over tasks. A slice, what one task
reads of a file, is run through once: braces in strings do not count, and a document ends where the depth is back at zero. Only files of
several slices need more: what each of their slices does to the state, from outside and from inside of a string, is summed up first (one row
a slice), and documents that cross a slice's end are put together from their fragments. Whole documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.session import ensure_checkpoints

_BETWEEN = r"^[\s,\[\]\x{FEFF}]*"
_BETWEEN_BYTES = re.compile(rb"(?:[ \t\n\x0b\f\r,\[\]]|\xef\xbb\xbf)*")
_COMPRESSED = re.compile(r"\.(gz|bz2|lz4|snappy|zst|zstd|deflate)$")
_BATCH_BYTES = 4 << 20
_SUMS = "file string, block bigint, size bigint, bytes bigint, plain boolean, quotes bigint, steps0 bigint, steps1 bigint, brackets0 bigint, brackets1 bigint"
_TEXTS = "file string, block bigint, at bigint, ended boolean, body binary"


class _Entry(NamedTuple):
    """What is known of a slice of several: the state it begins in, and how its file ends."""

    inside: int
    depth: int
    last: bool
    closed: bool
    balanced: bool


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, size, split, value): the pieces in order, without their ``}``; ``split`` if the file has several slices."""
    lines = spark.read.text(paths, lineSep="}")
    meta = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "block"), ("file_size", "size"))]
    split = (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("split")
    return lines.select(*meta, split, F.col("value").cast("binary").alias("value"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(file, block, size, split, pieces, bytes): runs of pieces of one slice, joined by their ``}``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy(zero_copy_only=False)
        cuts = {*pc.run_end_encode(file).run_ends.to_pylist(), *(np.flatnonzero(np.diff(block)) + 1).tolist()}
        start = 0
        for end in sorted(cuts):
            values = batch.column("value").slice(start, end - start)
            joined = pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), b"}")[0].as_py()
            size, split = batch.column("size")[start].as_py(), batch.column("split")[start].as_py()
            yield file[start].as_py(), int(block[start]), size, split, len(values), joined
            start = end


def _marks(data: bytes, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The bytes, whether each is in a string, and whether the end is, from the state ``inside`` on."""
    chars = np.frombuffer(data, np.uint8)
    quotes = chars == 34
    slashes = chars == 92
    if slashes.any():
        at = np.flatnonzero(quotes)
        other = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(chars))))
        before = at - 1
        run = np.where(before >= 0, before - other[before], 0)
        quotes[at[run % 2 == 1]] = False
    state = (np.cumsum(quotes) + inside) & 1
    return chars, state.astype(bool), int(state[-1]) if len(state) else inside


def _count(chars: np.ndarray, where: np.ndarray, up: int, down: int) -> int:
    return int(((chars == up) & where).sum()) - int(((chars == down) & where).sum())


def _plain(data: bytes) -> bool:
    """Whether the last piece holds nothing of a document."""
    last = data[data.rfind(b"}") + 1 :]
    return _BETWEEN_BYTES.match(last).end() == len(last)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a slice: what it does to quotes, depth and brackets from either state, its last ``}`` left out."""
    names = [c.split()[0] for c in _SUMS.split(", ")]
    found: dict[tuple, list] = {}
    for file, block, size, _, n, data in _chunks(batches):
        row = found.get((file, block))
        if row is not None:
            data = b"}" + data
        else:
            row = found[file, block] = [size, 0, True, 0, 0, 0, 0, 0]
        chars, state, _ = _marks(data, row[3] % 2)
        row[1] += len(data) + (row[1] == 0)
        row[2] = _plain(data)
        for i, where in enumerate((~state, state)):
            row[4 + i] += _count(chars, where, 123, 125)
            row[6 + i] += _count(chars, where, 91, 93)
        # only whether it is odd counts from here on
        row[3] = int(state[-1]) if len(state) else row[3]
    rows = [(*key, *row) for key, row in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)


def _entries(sums: DataFrame) -> dict[tuple[str, int], _Entry]:
    """The slices of files of several; a row for each block that Spark reads of these."""
    by_file: dict[str, list] = {}
    for row in sums.collect():
        by_file.setdefault(row.file, []).append(row)
    known = {}
    for file, slices in by_file.items():
        slices.sort(key=lambda s: s.block)
        closed = not slices[-1].plain if _COMPRESSED.search(file) else sum(s.bytes for s in slices) <= slices[-1].size
        inside = depth = brackets = 0
        states = []
        for s in slices:
            states.append((s.block, inside, depth))
            brackets += s[f"brackets{inside}"]
            depth += s[f"steps{inside}"]
            inside = (inside + s.quotes) % 2
            depth -= 1 - inside
        known |= {(file, b): _Entry(i, d, b == slices[-1].block, closed, brackets == 0) for b, i, d in states}
    return known


def _bodies(entries: dict[tuple[str, int], _Entry], fragments: bool):
    """Function from pieces to whole documents, or to the fragments at the ends of slices."""

    def malformed(file: str, text: bytes):
        return ValueError(f"malformed document in {file}: {text[:80].decode('utf-8', 'replace')}")

    def checked(file: str, text: bytes) -> bytes:
        text = text[_BETWEEN_BYTES.match(text).end() :]
        if not text.startswith(b"{"):
            raise malformed(file, text)
        return text

    class Slice:
        def __init__(self, file: str, block: int, size: int, split: bool):
            self.file, self.block, self.size, self.split = file, block, size, split
            entry = entries.get((file, block)) if split else None
            self.entry = entry or _Entry(0, 0, True, True, True)
            self.inside, self.depth, self.open, self.at, self.bytes, self.brackets = self.entry.inside, self.entry.depth, [], 0, 0, 0
            self.head, self.plain = split and block > 0, True
            if not self.entry.balanced:
                raise ValueError(f"malformed document: brackets do not match in {file}")

        def feed(self, data: bytes):
            chars, state, after = _marks(data, self.inside)
            at = np.flatnonzero(((chars == 123) | (chars == 125)) & ~state)
            steps = np.where(chars[at] == 123, 1, -1)
            depth = self.depth + np.cumsum(steps)
            if len(depth) and depth.min() < 0:
                raise malformed(self.file, b"".join([*self.open, data]).strip())
            if not self.split:
                self.brackets += _count(chars, ~state, 91, 93)
            start = 0
            for end in at[(depth == 0) & (steps == -1)].tolist():
                text = b"".join([*self.open, data[start : end + 1]])
                self.open, start = [], end + 1
                if not self.head:
                    if not fragments:
                        yield self.file, self.block, self.at, True, checked(self.file, text)
                elif fragments:
                    yield self.file, self.block, 0, True, text
                self.head = False
                self.at += 1
            self.open.append(data[start:])
            self.inside, self.depth = after, int(depth[-1]) if len(depth) else self.depth

        def add(self, n: int, data: bytes):
            # what came before ends with a brace after all
            yield from self.feed(b"}" + data if self.bytes else data)
            self.bytes += len(data) + 1
            self.plain = _plain(data)

        def finish(self):
            closed = not self.entry.last or self.entry.closed
            if not self.split:
                closed = not self.plain if _COMPRESSED.search(self.file) else self.bytes <= self.size
            if closed:
                yield from self.feed(b"}")
            rest = b"".join(self.open)
            if self.split:
                if fragments:
                    # a slice without any end is all fragment, and goes on with what the one before left
                    yield self.file, self.block, 0 if self.head else self.at, False, rest
                return
            if _BETWEEN_BYTES.match(rest).end() < len(rest):
                raise malformed(self.file, rest.strip())
            if self.brackets:
                raise ValueError(f"malformed document: brackets do not match in {self.file}")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for file, block, size, split, n, data in _chunks(batches):
            if now is None or (now.file, now.block) != (file, block):
                if now is not None:
                    yield from now.finish()
                now = Slice(file, block, size, split)
            yield from now.add(n, data)
        if now is not None:
            yield from now.finish()

    names = [c.split()[0] for c in _TEXTS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in texts(batches):
            rows.append(row)
            held += len(row[4]) + 100
            if held > _BATCH_BYTES:
                yield made(rows)
                rows, held = [], 0
        if rows:
            yield made(rows)

    return run


def _crossing(fragments: DataFrame) -> DataFrame:
    """Documents that cross the end of a slice, from their fragments; they belong to the slice they end in."""
    # a slice has at most a fragment that ends a document, or none, and after it one that does not
    opens = (F.col("at") > 0) | (F.col("block") == 0)
    order = W.partitionBy("file").orderBy("block", F.desc("ended"))
    grouped = fragments.withColumn("group", F.sum(F.when(~F.col("ended") & opens, 1).otherwise(0)).over(order))
    parts = grouped.groupBy("file", "group").agg(
        F.array_sort(F.collect_list(F.struct("block", "body"))).alias("p"), F.max("block").alias("block"), F.max("ended").alias("ended"))
    joined = parts.select("file", "block", "ended", F.array_join(F.transform("p", lambda p: p["body"].cast("string")), "").alias("whole"))
    stripped = joined.withColumn("text", F.regexp_replace("whole", _BETWEEN, ""))
    wrong = F.when(F.col("ended"), ~F.startswith("text", F.lit("{"))).otherwise(F.col("text") != "")
    broken = F.raise_error(F.concat(F.lit("malformed document in "), "file", F.lit(": "), F.substring("text", 1, 80)))
    checked = stripped.withColumn("text", F.when(wrong, broken).otherwise(F.col("text")))
    return checked.where("ended or text <> ''").select("file", "block", F.lit(0).cast("bigint").alias("at"), "text")


def document_bodies(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, block, at, text): every document of the files; ``at`` is its place among those that end in a slice, from 0.

    See ``document_texts`` for what a file may hold.
    """
    pieces = _pieces(spark, list(paths))
    entries = _entries(pieces.where("split").mapInArrow(_sums, _SUMS))
    whole = pieces.mapInArrow(_bodies(entries, False), _TEXTS).select("file", "block", "at", F.col("body").cast("string").alias("text"))
    if not entries:
        return whole
    return whole.unionByName(_crossing(pieces.where("split").mapInArrow(_bodies(entries, True), _TEXTS)))


def document_texts(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, place, text): every document of the files, ``place`` from 0 within a file.

    Documents may follow each other with white space, commas or nothing between them, and stand in arrays. Anything else between them, a
    document that does not end, or brackets that do not match, are an error when the texts are computed. Empty files have
    no documents. ``document_bodies`` has the texts without their places, which take a checkpoint.
    """
    ensure_checkpoints(spark)
    texts = document_bodies(spark, *paths).checkpoint()
    counts = texts.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return texts.join(counts, ["file", "block"]).select("file", (F.col("earlier") + F.col("at")).alias("place"), "text")
