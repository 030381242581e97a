"""Quality rules with line labelling: a linear-chain conditional random field marks lines as content or boilerplate.

Counts of words, symbols, equal lines and repeated word triples are exact and cover whole texts. The field has two
labels, binary features of a line and label transitions. The labels of lines are hidden: only documents are labelled, and a document's label
is a noisy sign on each of its lines, for a bad document has lines of prose too. So the field is fitted to the marginal likelihood of
the signs, summed over all labellings, and how far the signs can be trusted is estimated with it.
Viterbi decoding then labels every line of every document, and the share of words in content lines decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.words import SPACE, Words, chunks, paired, repeats, words_of

SAMPLE_DOCS = 3000
SEGMENT = 64
FEATURES = 24
#: First guess of P(good document | label of a line), for boilerplate and for content.
TRUST = (0.1, 0.97)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


class Field(NamedTuple):
    """Weights for label content against boilerplate, and transition scores [from, to] with 1 for content."""

    weights: np.ndarray
    transitions: np.ndarray


class Lines(NamedTuple):
    doc: np.ndarray
    n_words: np.ndarray
    codes: np.ndarray  # set bits are the features that hold
    base: dict[str, np.ndarray]  # exact counts per document


def _between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[ends] - sums[starts]


def _line_bounds(words: Words) -> tuple[np.ndarray, np.ndarray]:
    data, n = words.data, len(words.data)
    starts = np.unique(np.concatenate([words.offsets[:-1], np.flatnonzero(data == 10) + 1]))
    starts = starts[starts < n]
    ends = np.append(starts[1:], n)
    return starts, ends - (data[ends - 1] == 10)


def _seen_before(data: np.ndarray, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether an earlier line of the same document has the same bytes."""
    again = np.zeros(len(doc), bool)
    seen: set[bytes] = set()
    now = None
    for i, (d, a, b) in enumerate(zip(doc.tolist(), starts.tolist(), ends.tolist(), strict=True)):
        if d != now:
            seen, now = set(), d
        line = data[a:b].tobytes()
        again[i] = line in seen
        seen.add(line)
    return again


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """The lines with a word, their features, and the counts of their documents."""
    words = words_of(data, offsets)
    n_docs = len(offsets) - 1
    names, _ = words.numbered()
    n = len(names)

    repeated = np.zeros(n, bool)
    begin = np.flatnonzero(words.doc[: n - 2] == words.doc[2:]) if n > 2 else np.zeros(0, np.int64)
    triples = paired(paired(names[begin], names[begin + 1]), names[begin + 2]) if len(begin) else begin
    twice = begin[repeats(words.doc[begin], triples)[0] > 1]
    for k in range(3):
        repeated[twice + k] = True

    starts, ends = _line_bounds(words) if len(data) else (np.zeros(0, np.int64),) * 2
    of_word = np.searchsorted(starts, words.starts, side="right") - 1
    per_line = np.bincount(of_word, minlength=len(starts))
    full = np.flatnonzero(per_line)
    starts, ends, per_line = starts[full], ends[full], per_line[full]
    first = np.searchsorted(words.starts, starts)
    doc = words.doc[first] if n else np.zeros(0, np.int64)
    last = first + per_line - 1
    again = _seen_before(data, doc, starts, ends)

    solid = _between(~SPACE[data], starts, ends)
    symbols, upper, digits, bars, shouts = (
        _between(flags, starts, ends)
        for flags in (_SYMBOL[data], _UPPER[data], _DIGIT[data], data == ord("|"), data == ord("!"))
    )
    same = np.zeros(n, bool)
    same[1:] = (names[1:] == names[:-1]) & (words.doc[1:] == words.doc[:-1])
    stutter, echo = _between(same, first, last + 1), _between(repeated, first, last + 1)
    facts = [
        np.ones(len(full), bool),
        per_line <= 2, per_line <= 5, per_line >= 25,
        symbols * 50 > solid, symbols * 10 > solid,
        upper * 10 > solid * 3, upper * 10 > solid * 6,
        digits * 5 > solid,
        bars > 0,
        _STOP[data[words.ends[last] - 1]] if len(full) else np.zeros(0, bool),
        again,
        echo > 0, echo * 2 > per_line, echo * 10 > per_line * 9,
        shouts * 20 > solid,
        solid > 12 * per_line, solid < 3 * per_line,
        _UPPER[data[words.starts[first]]] if len(full) else np.zeros(0, bool),
        stutter * 5 > per_line,
        per_line >= 60,
        (per_line >= 25) & (symbols == 0) & (shouts == 0) & (echo * 5 <= per_line),
        symbols * 4 > solid,
        (per_line >= 25) & (symbols * 10 > solid),
    ]
    codes = np.zeros(len(full), np.int64)
    for bit, holds in enumerate(facts):
        codes |= holds.astype(np.int64) << bit

    letters = ((data & 0xC0) != 0x80) & ~SPACE[data]
    base = {
        "n_words": np.diff(words.first),
        "word_chars": _between(letters, offsets[:-1], offsets[1:]),
        "n_symbols": _between(_SYMBOL[data], offsets[:-1], offsets[1:]),
        "n_dup_lines": np.bincount(doc[again], minlength=n_docs)[:n_docs],
        "n_repeat_words": words.per_doc(repeated),
    }
    return Lines(doc, per_line, codes, base)


def _bits(codes: np.ndarray) -> np.ndarray:
    return (codes[..., None] >> np.arange(FEATURES)) & 1


class Chains:
    """Lines of documents in segments of ``SEGMENT``, padded; lines with equal features are told apart by place only."""

    def __init__(self, codes: list[np.ndarray], signs: list[np.ndarray]):
        parts = [(c[i : i + SEGMENT], z[i : i + SEGMENT]) for c, z in zip(codes, signs, strict=True) for i in range(0, len(c), SEGMENT)]
        parts.sort(key=lambda p: -len(p[0]))
        size = np.array([len(c) for c, _ in parts])
        self.inside = np.arange(size[0]) < size[:, None]
        forms, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        self.bits = _bits(forms).astype(float)
        self.form, self.sign = np.zeros(self.inside.shape, np.int64), np.zeros(self.inside.shape, np.int64)
        self.form[self.inside], self.sign[self.inside] = at, np.concatenate([z for _, z in parts])
        self.total = int(self.inside.sum())

    def sums(self, node: np.ndarray) -> np.ndarray:
        """Features of the content lines, by their probability."""
        return np.bincount(self.form[self.inside], node[self.inside], len(self.bits)) @ self.bits

    def marginals(self, theta: np.ndarray, evidence: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        return _marginals((self.bits @ theta[:FEATURES])[self.form] + evidence, theta[FEATURES:].reshape(2, 2), self.inside)

    def gradient(self, theta: np.ndarray, trust: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the log of the signs' likelihood per line, and the posterior of content; ``trust`` is P(good sign | label)."""
        odds = np.log(np.stack([(1 - trust[1]) / (1 - trust[0]), trust[1] / trust[0]]))
        free, moves = self.marginals(theta)
        held, held_moves = self.marginals(theta, odds[self.sign])
        return np.concatenate([self.sums(held) - self.sums(free), (held_moves - moves).ravel()]) / self.total, held


def _climb(theta: np.ndarray, gradient, steps: int, ridge: float) -> np.ndarray:
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        slope = gradient(theta, step) - ridge * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta


def fit_field(codes: list[np.ndarray], signs: list[np.ndarray], steps: int = 100, ridge: float = 1e-3) -> Field:
    """Fit to one sign per line, in three climbs.

    The first takes the signs for labels, the second climbs their marginal likelihood with hidden labels. Both leave the transitions
    out: signs are equal all through a document, and a chain would explain them by never changing its label. The third fits
    the whole field to the labels that are likeliest by the second, from a line's features alone: the signs leave open how
    much of a doubtful line is noise and how much label, sharp labels do not. Without lines of both signs every line is content.
    """
    given = [(c, z) for c, z in zip(codes, signs, strict=True) if len(c)]
    if len({int(v) for _, z in given for v in z}) < 2:
        return Field(np.eye(FEATURES)[0], np.zeros((2, 2)))
    chains = Chains([c for c, _ in given], [z for _, z in given])
    good = (chains.sign * chains.inside).astype(float)
    trust = np.array(TRUST)
    still = np.zeros(4)

    def told(node: np.ndarray, edge: np.ndarray | None):
        observed = chains.sums(node)

        def slope(theta: np.ndarray, step: int) -> np.ndarray:
            found, moves = chains.marginals(theta)
            rest = still if edge is None else (edge - moves).ravel()
            return np.concatenate([observed - chains.sums(found), rest]) / chains.total

        return slope

    def hidden(theta: np.ndarray, step: int) -> np.ndarray:
        slope, held = chains.gradient(theta, trust)
        if step % 10 == 0:
            for label, share in enumerate((1 - held, held)):
                weight = share[chains.inside]
                trust[label] = ((weight @ good[chains.inside]) + TRUST[label] * 20) / (weight.sum() + 20)
            trust[:] = np.clip(trust, (0.01, 0.6), (0.4, 0.99))
        return np.append(slope[:FEATURES], still)

    theta = _climb(np.zeros(FEATURES + 4), told(good, None), steps // 2, ridge)
    theta = _climb(theta, hidden, steps, ridge)
    held = (chains.marginals(theta)[0] >= 0.5).astype(float)
    sides = np.stack([1 - held, held], -1)
    both = np.where(chains.inside[:, 1:, None, None], sides[:, :-1, :, None] * sides[:, 1:, None, :], 0).sum((0, 1))
    theta = _climb(theta, told(held, both), steps, ridge)
    return Field(theta[:FEATURES], theta[FEATURES:].reshape(2, 2))


def _marginals(score: np.ndarray, moves: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content at each line, and expected transitions, by forward and backward sums."""
    n, length = score.shape
    local = np.stack([np.zeros_like(score), score], -1)
    ahead = np.zeros((n, length, 2))
    back = np.zeros((n, length, 2))
    ahead[:, 0] = local[:, 0]
    for t in range(1, length):
        step = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1]) + local[:, t]
        ahead[:, t] = np.where(inside[:, t, None], step, ahead[:, t - 1])
    for t in range(length - 2, -1, -1):
        after = back[:, t + 1] + local[:, t + 1]
        step = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
        back[:, t] = np.where(inside[:, t + 1, None], step, 0)
    norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None]
    node = np.exp(ahead[..., 1] + back[..., 1] - norm)
    both = ahead[:, :-1, :, None] + moves + (local + back)[:, 1:, None, :] - norm[..., None, None]
    return node, np.where(inside[:, 1:, None, None], np.exp(both), 0).sum((0, 1))


def viterbi(field: Field, codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Best labels of all lines; each document is a chain of its own. Ties go to content."""
    gain = (_bits(codes) @ field.weights).tolist()
    chain = doc.tolist()
    (stay0, up), (down, stay1) = field.transitions.tolist()
    n = len(chain)
    if not n:
        return np.zeros(0, bool)
    from0, from1 = bytearray(n), bytearray(n)
    low, high, now = 0.0, 0.0, None
    ends = []
    for i in range(n):
        if chain[i] != now:
            if now is not None:
                ends.append((i - 1, high >= low))
            low, high, now = 0.0, gain[i], chain[i]
            continue
        a, b = low + stay0, high + down
        c, d = low + up, high + stay1
        from0[i], from1[i] = b >= a, d >= c
        low, high = max(a, b), max(c, d) + gain[i]
    ends.append((n - 1, high >= low))
    labels = np.zeros(n, bool)
    for (last, label), start in zip(reversed(ends), reversed([0, *[e + 1 for e, _ in ends[:-1]]]), strict=True):
        for i in range(last, start - 1, -1):
            labels[i] = label
            label = from1[i] if label else from0[i]
    return labels


def _sample(docs: DataFrame, labels: DataFrame, train: Column | None, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents, chosen by a hash of their id."""
    rows = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    if train is not None:
        rows = rows.where(train)
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # a doc_id with several texts is represented by the first in order
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_quality").agg(F.min("text").alias("text"))


def train_field(docs: DataFrame, labels: DataFrame, train: Column | None = None, limit: int = SAMPLE_DOCS) -> Field:
    """Fit on at most ``limit`` documents of ``labels(doc_id, quality)``; ``train`` restricts them further.

    Without both kinds of documents every line is content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality = batch.column(1).to_pylist()
            out: tuple[list, list] = ([], [])
            for row, stop, data, offsets in chunks(batch.column(0)):
                lines = lines_of(data, offsets)
                at = np.searchsorted(lines.doc, np.arange(stop - row + 1))
                for i in range(stop - row):
                    out[0].append(lines.codes[at[i] : at[i + 1]])
                    out[1].append(quality[row + i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.list_(pa.int64())), pa.array(out[1], pa.int32())], ["codes", "quality"]
            )

    given = _sample(docs, labels, train, limit).select("text", F.col("_quality").cast("int"))
    rows = given.mapInArrow(run, "codes array<bigint>, quality int").collect()
    rows = [r for r in rows if r.codes]
    return fit_field([np.array(r.codes, np.int64) for r in rows], [np.full(len(r.codes), r.quality, np.int64) for r in rows])


def quality_report(docs: DataFrame, field: Field, min_share: float = 0.5) -> DataFrame:
    """doc_id, the exact counts, base_failed, the content share and the verdict, for every row of ``docs``.

    Nulls: a null text has no words, so it fails the base rules; a null doc_id is returned as it is. Repeated rows are judged
    alike. An empty table gives no rows. Further columns are not read, whatever their names.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in chunks(batch.column(1)):
                lines = lines_of(data, offsets)
                content = viterbi(field, lines.codes, lines.doc)
                n = lines.base["n_words"]
                share = np.bincount(lines.doc, lines.n_words * content, minlength=stop - row) / np.maximum(n, 1)
                failed = (n < 50) | (100 * lines.base["n_repeat_words"] > 50 * n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, stop - row), *[pa.array(lines.base[c].astype(np.int64)) for c in counts],
                     pa.array(failed), pa.array(~failed & (share >= min_share)), pa.array(share)],
                    ["doc_id", *counts, "base_failed", "kept", "content_share"],
                )

    schema = ", ".join([f"doc_id {kind}", *[f"{c} bigint" for c in counts], "base_failed boolean, kept boolean, content_share double"])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
