"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posterior.

Voters are a small general lexicon, patterns, and words or word beginnings mined from labelled toxic documents; each
fires or stays silent. The label model estimates how often each voter fires in toxic and in clean documents, with the label
itself hidden, and how strongly voters go together beyond the label; voters that go together share
their evidence. The classifier is a logistic regression over the voters, fitted to the posterior.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.storage import stored

SAMPLE_DOCS = 20_000
MIN_SUPPORT = 3
#: Voters count as related from this correlation within the labels.
RELATED = 0.3
#: A general lexicon of insults.
LEXICON = (
    "idiot", "moron", "stupid", "dumb", "fool", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
    "imbecile", "filth", "vermin", "retard", "jerk", "bastard", "coward", "ugly",
)
#: Patterns of aggressive writing.
PATTERNS = {
    "masked word": r"\b\w[*#$%&@]{2,}\w?",
    "many exclamation marks": r"!{3,}",
    "stretched letters": r"([^\W\d_])\1{3,}",
    "address": r"\b(?:you are|you're|shut up|go away)\b",
}
_WORD = re.compile(r"[^\W\d_]{2,}")
_COMPILED = [re.compile(p, re.IGNORECASE) for p in PATTERNS.values()]
_PREFIXES = (4, 5, 6)
_FLUSH = 200_000


class Model(NamedTuple):
    features: dict[str, int]  # word or "^beginning" -> voter
    weights: np.ndarray  # of the voters, then of the patterns
    bias: float


def word_features(text: str | None) -> set[str]:
    """The distinct lower-case words of a text and their beginnings."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"^{w[:n]}" for w in words for n in _PREFIXES if len(w) >= n}


def _fired(text: str | None, features: dict[str, int]) -> list[int]:
    found = {features[f] for f in word_features(text) & features.keys()}
    extra = [len(features) + i for i, p in enumerate(_COMPILED) if p.search(text or "")]
    return sorted(found) + extra


def _wilson(hits: Column, total: Column, z: float = 1.64) -> Column:
    """Lower end of the confidence interval of a share."""
    p = hits / total
    return (p + z * z / (2 * total) - z * F.sqrt(p * (1 - p) / total + z * z / (4 * total * total))) / (1 + z * z / total)


def _marking(sample: DataFrame, base: float, min_support: int) -> DataFrame:
    """Words and beginnings that mark toxic documents of the sample: feature, and n toxic and ``missed`` clean documents with it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in (seen[1], seen[0]))]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["feature", "n", "missed"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                seen[toxic.as_py() == 1].update(word_features(text.as_py()))
                if len(seen[0]) + len(seen[1]) > _FLUSH:
                    yield flush()
        yield flush()

    parts = sample.select("text", "toxic").where("toxic in (0, 1)").mapInArrow(count, "feature string, n bigint, missed bigint")
    counts = parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("missed").alias("missed")).where(F.col("n") >= min_support)
    return counts.where(_wilson(F.col("n"), F.col("n") + F.col("missed")) >= max(0.4, 2 * base))


def _mine(sample: DataFrame, base: float, min_support: int = MIN_SUPPORT) -> list[str]:
    """The words and beginnings that mark toxic documents of the sample, most useful first."""
    good = sorted(r.feature for r in _marking(sample, base, min_support).select("feature").collect())
    number = {f: i for i, f in enumerate(good)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(number[f] for f in word_features(t.as_py()) & number.keys()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["found"])

    toxic = sample.where("toxic = 1").select("text")
    docs = [r.found for r in toxic.mapInArrow(present, "found array<int>").collect() if r.found]
    return [good[i] for i in _cover(docs, len(good), min_support)]


def _cover(docs: list[list[int]], n: int, min_support: int = MIN_SUPPORT) -> list[int]:
    """Features by the documents they explain; one explained already counts a quarter.

    So words that only ride along in copies of one document get no vote.
    """
    holders: list[list[int]] = [[] for _ in range(n)]
    for d, found in enumerate(docs):
        for f in found:
            holders[f].append(d)
    worth, gain = np.ones(len(docs)), np.array([float(len(h)) for h in holders])
    chosen: list[int] = []
    while len(chosen) < n:
        best = int(gain.argmax())
        if gain[best] < min_support - 0.5:
            break
        chosen.append(best)
        for d in holders[best]:
            loss = 0.75 * worth[d]
            worth[d] -= loss
            gain[docs[d]] -= loss
        gain[best] = -1
    return chosen


def fit_label_model(votes: np.ndarray, toxic: np.ndarray, strong: int, rounds: int = 40) -> np.ndarray:
    """Posterior probability of toxic for each row of 0/1 votes; the first ``strong`` columns are lexical voters.

    Expectation maximisation over a hidden label. The given labels are noisy prior counts of how often each voter fires, no
    more. A voter's evidence is divided by one plus its correlations with the others within the labels,
    so a group of voters that repeat each other counts about once.
    """
    prior = float(np.clip(toxic.mean(), 0.001, 0.5))
    posterior = np.where(votes[:, :strong].any(1), 0.9, 0.02)
    known = toxic @ votes, (1 - toxic) @ votes, toxic.sum(), (1 - toxic).sum()
    for turn in range(rounds):
        p = posterior.mean()
        # a voter is believed to be better than chance until the votes say otherwise
        fire1 = (posterior @ votes + known[0] + 4 * 0.2) / (posterior.sum() + known[2] + 4)
        fire0 = ((1 - posterior) @ votes + known[1] + 4 * 0.002) / ((1 - posterior).sum() + known[3] + 4)
        if turn % 10 == 0:
            rest = votes - (posterior[:, None] * fire1 + (1 - posterior)[:, None] * fire0)
            scale = np.sqrt((rest**2).sum(0)) + 1e-9
            together = (rest.T @ rest) / np.outer(scale, scale)
            share = 1 / np.where(together > RELATED, together, 0).sum(1).clip(1)
        yes, no = np.log(fire1 / fire0) * share, np.log((1 - fire1) / (1 - fire0)) * share
        p = 0.5 * p + 0.5 * prior
        logit = np.log(p / (1 - p)) + votes @ (yes - no) + no.sum()
        posterior = 1 / (1 + np.exp(-logit.clip(-30, 30)))
    return posterior


def fit_linear(votes: np.ndarray, target: np.ndarray, steps: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels."""
    w, b = np.zeros(votes.shape[1]), 0.0
    mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        miss = target - 1 / (1 + np.exp(-(votes @ w + b)))
        gradient = np.append(votes.T @ miss / len(votes) - ridge * w, miss.mean())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, b = w + move[:-1], b + move[-1]
    return w, float(b)


def fit_scale(scores: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities of the given labels (Newton steps on the logistic loss).

    The labels count half a document of each kind more than there are, so perfect scores keep finite slopes.
    """
    unit = max(float(scores.std()), 1e-9)
    x = np.stack([scores / unit, np.ones(len(scores))], 1)
    soft = label * (1 - 1e-3) + 5e-4
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        curve = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-6 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, x.T @ (soft - p)), -2, 2)
    return (float(theta[0] / unit), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def train(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    limit: int = SAMPLE_DOCS,
    min_support: int = MIN_SUPPORT,
) -> Model:
    """Fit on at most ``limit`` documents of ``labels(doc_id, toxic)``, chosen by a hash of their id.

    Every word or beginning in at least ``min_support`` toxic documents that marks them well is a candidate; of these
    vote, taken by the toxic documents they explain, all until the next would add fewer than ``min_support`` (less a half).
    Documents with equal text count once. Without labelled documents only the general lexicon votes.
    """
    rows = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    rows = rows if use is None else rows.where(use)
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = stored(sample.groupBy("text").agg(F.max("_toxic").alias("toxic")))
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = float(np.clip(toxic / max(n, 1), 0.001, 0.5))
    names = list(dict.fromkeys([*LEXICON, *(_mine(sample, prior, min_support) if toxic else [])]))
    features = {f: i for i, f in enumerate(names)}
    width = len(features) + len(PATTERNS)

    def fire(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fired(t.as_py(), features) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1).cast(pa.int32())], ["found", "toxic"])

    found = sample.select("text", "toxic").mapInArrow(fire, "found array<int>, toxic int").collect()
    # and one document of each kind, so that nothing is degenerate: silence is clean, all lexical voters at once are toxic
    votes, label = np.zeros((len(found) + 2, width), np.float32), np.zeros(len(found) + 2)
    for i, row in enumerate(found):
        votes[i, row.found], label[i] = 1, row.toxic
    votes[-1, : len(features)], label[-1] = 1, 1
    weights, bias = fit_linear(votes, fit_label_model(votes, label, len(features)))
    slope, shift = fit_scale(votes @ weights + bias, label)
    return Model(features, slope * weights, slope * bias + shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) for every row.

    Nulls: a null or empty text fires no voter; a null doc_id is returned as it is. Repeated rows get equal scores. An empty table
    gives no rows. Further columns are not read, whatever their names.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = [model.weights[_fired(t.as_py(), model.features)].sum() + model.bias for t in batch.column(1)]
            scores = 1 / (1 + np.exp(-np.clip(np.array(logits, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
