"""Substring deduplication by recompression.

A text is a sequence of words. In each round, maximal runs of one symbol get the name of (symbol, length), and then
neighbours *ab* with *a* a left and *b* a right letter get the name of the pair; a letter's side is one bit of its
name. Names are hashes of what they stand for, so every task gives equal strings equal names without
talking to another. Inside a repeated string all symbols come out alike except at its two ends: a round drops at most the
outermost run and then one letter on each side. What is left of a window is its core, and it depends on the window alone.

The window is filed under the symbol of its core that covers most words (its anchor). Equal windows thus meet in one anchor
symbol; anchors that occur once are no repeats. A window without a core is filed under its own hash. Neighbouring
windows of one anchor form a span. Spans that are equal verify all their windows at once, the rest of an anchor's
windows are compared one by one. Anchors are built from one half of the words' 128-bit hashes, spans and windows are verified by
polynomials modulo a prime over the other half, so what makes a candidate has no say in its verification.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.storage import discard, from_row, stored, whole_row
from flowtide.llm.words import chunks, mix, span_hashes, words_of

ROUNDS = 3
_RUN, _PAIR, _SIDE, _LOOSE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_SIDES = np.arange(1, 65, dtype=np.uint64) * _SIDE


def compress(names: np.ndarray, doc: np.ndarray, salt: int):
    """One round over symbols and their text numbers: new names, first old symbol of each, the map of cores."""
    n = len(names)
    change = np.ones(n, bool)
    change[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    run_of = np.cumsum(change) - 1
    starts = np.flatnonzero(change)
    length = np.diff(np.append(starts, n)).astype(np.uint64)
    runs, run_doc = names[starts], doc[starts]
    runs = np.where(length > 1, mix(runs * _RUN + length), runs)
    right = (mix(runs + _SIDES[salt]) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(runs), bool)
    pair[:-1] = ~right[:-1] & right[1:] & (run_doc[:-1] == run_doc[1:])
    second = np.zeros(len(runs), bool)
    second[1:] = pair[:-1]
    heads = np.flatnonzero(~second)
    new_of = np.cumsum(~second) - 1
    joined = runs[heads]
    both = pair[heads]
    joined[both] = mix(joined[both] * _PAIR + mix(runs[heads[both] + 1] + np.uint64(salt)))

    def cores(low: np.ndarray, high: np.ndarray, alive: np.ndarray):
        low, high = run_of[low] + 1, run_of[high - 1]  # the outer runs may go on outside
        alive &= low < high
        low, high = np.where(alive, low, 0), np.where(alive, high, 1)
        low = low + right[low]  # may be the second of a pair that begins outside
        high = high - ~right[high - 1]  # may be the first of a pair that ends outside
        alive &= low < high
        low, high = np.where(alive, low, 0), np.where(alive, high, 1)
        return new_of[low], new_of[high - 1] + 1, alive

    return joined, starts[heads], cores


def anchors(hashes: np.ndarray, doc: np.ndarray, window: int, rounds: int = ROUNDS):
    """First words of all windows, their anchor's name, and a number that neighbours with the same anchor share."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begin = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    low, high, alive = begin, begin + window, np.ones(len(begin), bool)
    names, at, of = hashes, np.arange(n), doc
    for salt in range(rounds):
        names, heads, cores = compress(names, of, salt)
        at, of = at[heads], of[heads]
        low, high, alive = cores(low, high, alive)
    size = np.diff(np.append(at, n)).clip(0, 15).astype(np.uint64)
    order = ((np.uint64(15) - size) << np.uint64(58)) | (mix(names) >> np.uint64(6))
    table = [np.arange(len(names))]
    widest = int((high - low)[alive].max()) if alive.any() else 0
    while 2 << (len(table) - 1) <= widest:
        half = 1 << (len(table) - 1)
        one, two = table[-1][:-half], table[-1][half:]
        table.append(np.where(order[one] <= order[two], one, two))
    best = np.full(len(begin), -1, np.int64)
    level = np.frexp((high - low).astype(float))[1] - 1
    for k, row in enumerate(table):
        which = np.flatnonzero(alive & (level == k))
        one, two = row[low[which]], row[high[which] - (1 << k)]
        best[which] = np.where(order[one] <= order[two], one, two)
    key = np.empty(len(begin), np.uint64)
    key[alive] = names[best[alive]]
    loose = np.flatnonzero(~alive)
    key[loose] = span_hashes(hashes, begin[loose], begin[loose] + window) ^ _LOOSE
    best[loose] = -2 - np.arange(len(loose))
    return begin, key, best


def _spans(begin: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window (as indices) of each group of neighbouring windows with one anchor."""
    new = np.ones(len(begin), bool)
    new[1:] = (best[1:] != best[:-1]) | (begin[1:] != begin[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(begin)) - 1


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _text_id() -> list[Column]:
    """Two independent hashes: equal texts are one text."""
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]


def _find_spans(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = (batch.column(i).to_numpy() for i in (0, 1))
            for row, _, data, offsets in chunks(batch.column(2)):
                words = words_of(data, offsets)
                names, others = words.names()
                begin, key, best = anchors(names, words.doc, window)
                if not len(begin):
                    continue
                first, last = _spans(begin, best)
                low, high = begin[first], begin[last]
                doc = words.doc[low]
                base = words.first[doc]
                span = span_hashes(others, low, high + window)
                yield pa.RecordBatch.from_arrays(
                    [_long(key[first]), _long(span), pa.array(t1[row + doc]), pa.array(t2[row + doc]),
                     pa.array((low - base).astype(np.int32)), pa.array((high - base).astype(np.int32))],
                    ["key", "span", "t1", "t2", "low", "high"],
                )

    return run


def _window_hashes(window: int):
    """Of the listed spans of each text: one row per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = (batch.column(i).to_numpy() for i in (0, 1))
            lists = batch.column(3)
            for row, stop, data, offsets in chunks(batch.column(2)):
                words = words_of(data, offsets)
                part = lists.slice(row, stop - row)
                flat = part.flatten()
                doc = np.repeat(np.arange(stop - row), part.value_lengths().to_numpy())
                key, span, low, high, unique = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
                count = (high - low + 1).astype(np.int64)
                which = np.repeat(np.arange(len(low)), count)
                at = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                begin = words.first[doc[which]] + at
                shape = span_hashes(words.names()[1], begin, begin + window)
                owner = row + doc[which]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[which]), _long(shape), pa.array(span[which]), pa.array(t1[owner]), pa.array(t2[owner]),
                     pa.array(at.astype(np.int32)), pa.array(unique[which])],
                    ["key", "shape", "span", "t1", "t2", "low", "unique"],
                )

    return run


def repeated_ranges(docs: DataFrame, window: int = 35, places: list[str] | None = None) -> DataFrame:
    """(t1, t2, ranges): the word ranges [low, high) of each text that repeated windows cover.

    ``t1`` and ``t2`` identify the text. Only grouped counts and joins with their results are used, so an anchor
    or a passage with a third of all rows is combined before it is shuffled, and never gathered. The folders
    of intermediate tables, which the result reads, are added to ``places``.
    """
    schema = "key bigint, span bigint, t1 bigint, t2 bigint, low int, high int"
    texts = docs.where("text is not null").select(*_text_id(), "text")
    spans = stored(texts.mapInArrow(_find_spans(window), schema), places)
    keys = spans.groupBy("key").agg(F.count("*").alias("n"), (F.min("span") != F.max("span")).alias("mixed"))
    # stored, so that the join reads both sides from plain shuffles and Spark can split a hot key
    shared = stored(spans.join(stored(keys.where("n > 1").drop("n"), places), "key"), places)
    forms = shared.groupBy("key", "span").agg(
        F.count("*").alias("n"), F.first("mixed").alias("mixed"), *[F.first(c).alias(c) for c in ("t1", "t2", "low", "high")]
    )
    forms = stored(forms, places)
    whole = shared.join(forms.where("n > 1").select("key", "span"), ["key", "span"], "left_semi")

    listed = forms.where("mixed").groupBy("t1", "t2").agg(
        F.collect_list(F.struct("key", "span", "low", "high", (F.col("n") == 1).alias("unique"))).alias("spans")
    )
    schema = "key bigint, shape bigint, span bigint, t1 bigint, t2 bigint, low int, unique boolean"
    firsts = docs.groupBy(*_text_id()).agg(F.min("doc_id").alias("_first"))
    chosen = docs.select(*_text_id(), "text", "doc_id").join(listed.join(firsts, ["t1", "t2"]), ["t1", "t2"])
    chosen = chosen.where(F.col("doc_id").eqNullSafe(F.col("_first"))).select("t1", "t2", "text", "spans")
    windows = stored(chosen.mapInArrow(_window_hashes(window), schema), places)
    again = windows.groupBy("key", "shape").agg(F.min("span").alias("a"), F.max("span").alias("b")).where("a <> b")
    single = windows.where("unique").join(again.select("key", "shape"), ["key", "shape"], "left_semi")

    end = (F.col("high") + window).alias("high")
    ranges = whole.select("t1", "t2", "low", end).union(
        single.select("t1", "t2", "low", (F.col("low") + window).alias("high"))
    )
    longest = ranges.groupBy("t1", "t2", "low").agg(F.max("high").alias("high"))
    return longest.groupBy("t1", "t2").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))


def _kept(words: list[bytes], ranges: list[dict] | None) -> tuple[list[bytes], int]:
    """Words outside all ranges, and how many are inside."""
    if not ranges or not words:
        return words, 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [r["low"] for r in ranges], 1)
    np.add.at(edge, [r["high"] for r in ranges], -1)
    keep = np.cumsum(edge[:-1]) == 0
    kept = [words[i] for i in np.flatnonzero(keep)]
    return kept, len(words) - len(kept)


def with_ranges(docs: DataFrame, window: int = 35) -> DataFrame:
    """(text, ranges, _row): the ranges of each text that are covered (null: none), and the other columns."""
    places: list[str] = []
    ranges = stored(repeated_ranges(docs, window, places)).toDF("_t1", "_t2", "ranges")
    discard(places)
    t1, t2 = _text_id()
    marked = docs.select("text", whole_row(docs, "text"), t1, t2)
    return marked.join(ranges, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left").select("text", "ranges", "_row")


def removal_report(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the words that stay, for every row of ``docs``.

    Nulls: a null text has no words; a null ``doc_id`` is returned as it is. Equal rows are repeats of each other.
    Texts shorter than the window lose nothing. An empty table gives no rows. Further columns are not read, whatever their names.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, digest = [], [], []
            texts = batch.column(1).cast(pa.large_binary())
            for text, ranges in zip(texts, batch.column(2), strict=True):
                words = (text.as_py() or b"").split()
                kept, removed = _kept(words, ranges.as_py())
                total.append(len(words))
                gone.append(removed)
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    found = with_ranges(docs.select("doc_id", "text"), window).select("_row.doc_id", "text", "ranges")
    return found.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """``docs`` with the covered words cut out of ``text``; texts that lose nothing stay as they are, byte by byte.

    ``n_chars``, where there is one, follows the new text. A text of which nothing stays is empty, a null text stays null. An empty
    table gives no rows. All other columns stay, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            out = []
            for text, ranges in zip(texts, batch.column(1), strict=True):
                raw = text.as_py()
                kept, removed = _kept((raw or b"").split(), ranges.as_py())
                out.append(b" ".join(kept) if removed else raw)
            new = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([new, batch.column(2)], ["_text", "_row"])

    found = with_ranges(docs, window)
    schema = type(docs.schema)().add("_text", docs.schema["text"].dataType).add("_row", found.schema["_row"].dataType)
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return found.mapInArrow(run, schema).select(*from_row(found, docs.columns, **changed))
