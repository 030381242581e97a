"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter triple is bound into one vector by multiplying the three, each
permuted (rotated) by its place. A text is the bundle (sum) of its triples, a language the bundle of the texts
that bear its name, and a text goes to the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.storage import from_row, whole_row

DIMENSIONS = 1024
SAMPLE_DOCS = 50_000
UNKNOWN = "und"
#: From this many triples on, the cosine tells a language from other text (sf0.1: from 160 different triples on, none is under 0.46).
MIN_VARIETY = 100
_BLOCK_DOCS = 64
_BLOCK_CHARS = 1 << 20
_SEED = 41
SLICE_CHARS = 1 << 18
SLICE_TRIPLES = 4096


class Model(NamedTuple):
    languages: list[str]  # in order
    prototypes: np.ndarray  # unit length


@cache
def _letters() -> np.ndarray:
    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 0
    return np.strings.isalpha(points.view("U1"))


@lru_cache(maxsize=1 << 15)
def _letter_vector(point: int) -> np.ndarray:
    """The vector of a letter; 0 stands for everything between words."""
    return np.random.default_rng([_SEED, point]).integers(0, 2, DIMENSIONS).astype(np.int8) * np.int8(2) - np.int8(1)


class Triples:
    """Bound vectors of letter triples, kept for the next block of texts."""

    LIMIT = 30_000

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.vectors = np.zeros((1024, DIMENSIONS), np.int8)

    def of(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.tolist()
        if len(self.rows) + len(keys) > self.LIMIT:
            self.rows.clear()
        for key in keys:
            if key not in self.rows:
                row = len(self.rows)
                if row == len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                a, b, c = (_letter_vector(key >> shift & 0x1FFFFF) for shift in (42, 21, 0))
                self.vectors[row] = np.roll(a, 2) * np.roll(b, 1) * c
                self.rows[key] = row
        return self.vectors[[self.rows[key] for key in keys]].astype(np.float32)


def triple_slices(texts: list[str | None], size: int = SLICE_CHARS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Letter triples of the texts, in slices of ``size`` characters: distinct keys, which of them each triple is, its text's number.

    A word's outer letters have a boundary beside them, also at the ends of a text.
    """
    lowered = [(t or "").lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(texts))
    ends = np.cumsum(sizes)
    whole = "".join(lowered)
    for low in range(0, len(whole), size):
        high = min(low + size, len(whole))
        # one more character on each side
        first, last = max(low - 1, 0), min(high + 1, len(whole))
        points = np.frombuffer(whole[first:last].encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.searchsorted(ends, np.arange(first, last), side="right")
        padded = np.concatenate([[0], np.where(_letters()[points], points, 0).astype(np.int64), [0]])
        owner = np.concatenate([[-1], doc, [-1]])
        left = np.where(owner[:-2] == doc, padded[:-2], 0)
        right = np.where(owner[2:] == doc, padded[2:], 0)
        middle = padded[1:-1]
        here = middle > 0
        here[: low - first] = False
        here[high - first :] = False
        left, middle, right, doc = left[here], middle[here], right[here], doc[here]
        if not len(doc):
            continue
        present = np.zeros(0x110000, bool)
        for part in (left, middle, right):
            present[part] = True
        alphabet = np.flatnonzero(present)
        n = len(alphabet)
        small = np.zeros(0x110000, np.int64)
        small[alphabet] = np.arange(n)
        ids = (small[left] * n + small[middle]) * n + small[right]
        if n <= 200:
            seen = np.zeros(n**3, bool)
            seen[ids] = True
            found = np.flatnonzero(seen)
            at = (np.cumsum(seen) - 1)[ids]
        else:
            found, at = np.unique(ids, return_inverse=True)
        yield (alphabet[found // (n * n)] << 42) | (alphabet[found // n % n] << 21) | alphabet[found % n], at, doc


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if i + 1 - start == _BLOCK_DOCS or size > _BLOCK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def bundles(texts: list[str | None], triples: Triples) -> np.ndarray:
    """Sums of the triples' vectors, taken ``SLICE_TRIPLES`` distinct ones at a time, so memory does not follow the texts."""
    total = np.zeros((len(texts), DIMENSIONS))
    for keys, at, doc in triple_slices(texts):
        if len(keys) > SLICE_TRIPLES:
            order = np.argsort(at, kind="stable")
            at, doc = at[order], doc[order]
        cuts = np.searchsorted(at, np.arange(0, len(keys) + SLICE_TRIPLES, SLICE_TRIPLES)) if len(keys) > SLICE_TRIPLES else [0, len(at)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            part = keys[k * SLICE_TRIPLES : (k + 1) * SLICE_TRIPLES]
            counts = np.bincount(doc[a:b] * len(part) + at[a:b] - k * SLICE_TRIPLES, minlength=len(texts) * len(part))
            total += counts.reshape(len(texts), len(part)).astype(np.float32) @ triples.of(part)
    return total.astype(np.float32)


def train(docs: DataFrame, use: Column | None = None, limit: int = SAMPLE_DOCS) -> Model:
    """Prototypes from the documents that have text and lang: all of a language, or about ``limit`` chosen by a hash of their id.

    So a rare language is learned in a table of any size. ``use`` restricts the documents. Per language, only sums over its texts leave the tasks.
    """
    labelled = docs.where("lang is not null and text is not null")
    labelled = labelled if use is None else labelled.where(use)
    buckets = 1 << 20
    large = labelled.groupBy("lang").count().where(F.col("count") > limit).collect()
    if large:
        parts = F.create_map(*[F.lit(x) for r in large for x in (r.lang, max(1, int(limit / r["count"] * buckets)))])
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) < F.coalesce(parts[F.col("lang")], F.lit(buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples, sums = Triples(), {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, stop in _blocks(texts):
                vectors = bundles(texts[start:stop], triples)
                for lang, vector in zip(langs[start:stop], vectors, strict=True):
                    norm = float(np.linalg.norm(vector))
                    if norm:
                        sums[lang] = sums.get(lang, 0) + vector.astype(np.float64) / norm
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([np.rint(vector * 2**20).astype(np.int64)])], ["lang", "total"])

    parts = labelled.select("lang", "text").mapInArrow(run, "lang string, total array<bigint>")
    sums = parts.select("lang", F.posexplode("total")).groupBy("lang", "pos").agg(F.sum("col").alias("value"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("v")).select("lang", "v.value")
    found = sorted((r.lang, np.array(r.value, float)) for r in rows.collect())
    prototypes = np.array([v / np.linalg.norm(v) for _, v in found]).reshape(len(found), DIMENSIONS)
    return Model([lang for lang, _ in found], prototypes.astype(np.float32))


def predict(texts: list[str | None], model: Model, triples: Triples) -> tuple[list[str], np.ndarray]:
    """Language and cosine of each text; ``und`` and 0 without letters or without any learned language."""
    names, scores = [], np.zeros(len(texts))
    for start, stop in _blocks(texts):
        vectors = bundles(texts[start:stop], triples)
        norms = np.linalg.norm(vectors, axis=1)
        if not model.languages:
            names += [UNKNOWN] * (stop - start)
            continue
        cosines = vectors @ model.prototypes.T / np.maximum(norms, 1e-12)[:, None]
        best = cosines.argmax(1)
        names += [model.languages[b] if norm else UNKNOWN for b, norm in zip(best, norms, strict=True)]
        scores[start:stop] = np.where(norms > 0, cosines.max(1).clip(0, 1), 0)
    return names, scores


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score for every row.

    Nulls: a null text is ``und`` with score 0; a null doc_id is returned as it is. Repeated rows get the same answer, ties go to
    the language first in order. An empty table gives no rows. Further columns are not read, whatever their names.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples = Triples()
        for batch in batches:
            names, scores = predict(batch.column(1).to_pylist(), model, triples)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def variety(texts: list[str | None]) -> np.ndarray:
    """How many triples each text would have if all of its triples were equally frequent: (sum of counts)^2 / sum of squares."""
    found = np.zeros(len(texts))
    for i, text in enumerate(texts):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for more, at, _ in triple_slices([text]):
            joined = np.concatenate([keys, more])
            keys, of = np.unique(joined, return_inverse=True)
            counts = np.bincount(of, np.concatenate([counts, np.bincount(at)])).astype(np.int64)
        found[i] = counts.sum() ** 2 / max((counts.astype(float) ** 2).sum(), 1)
    return found


def accepted(docs: DataFrame, model: Model, min_score: float, min_variety: float = MIN_VARIETY) -> DataFrame:
    """The rows of ``docs`` with letters, less those unlike every learned language; all columns stay.

    A text is unlike a language below a cosine of ``min_score``. The cosine of good prose grows with the number of its triples, so a
    text whose ``variety`` is under ``min_variety`` is too short or too repetitive to tell, and stays. Without any learned
    language no row is accepted, an empty table gives no rows. Nulls and empty texts have no letters; repeated rows are judged alike.
    Memory follows slices of a text, never a whole one's triples.
    """
    given = docs.select("text", whole_row(docs, "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples = Triples()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            names, scores = predict(texts, model, triples)
            kept = np.array([n != UNKNOWN for n in names], bool)
            low = np.flatnonzero(kept & (scores < min_score))
            kept[low] = variety([texts[i] for i in low]) < min_variety
            yield batch.filter(pa.array(kept))

    kept = given.mapInArrow(run, given.schema)
    return kept.select(*from_row(kept, docs.columns, text=F.col("text")))
