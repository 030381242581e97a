"""HTML extraction with a recurrent block labeller.

A page is the sequence of its leaf blocks. Every block is a vector of its hashed tag path, its hashed words and a few measures;
a bidirectional LSTM in numpy reads the whole sequence, so a block's label depends on the document before and behind it. The blocks
labelled as article, in page order, are the text.

It is trained here, with back-propagation through time, on a bounded sample of pages: the pages themselves, where an
``article`` or ``main`` element tells the label, and random layouts around their text (``page_templates``), where the layout tells it.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.html_blocks import Block, blocks
from flowtide.llm.page_templates import MARK, NAMES, Material, Page

SAMPLE_PAGES = 200
SAMPLE_CHARS = 100_000
RENDERED = 2000
EPOCHS = 8
HIDDEN = 24
PATH_DIMS, WORD_DIMS = 4096, 1024
MEASURES = 10
SEGMENT = 96
_PAGES_AT_ONCE = 64
_BLOCKS_AT_ONCE = 8192
_BOILERPLATE = {p for role, names in NAMES.items() if role not in ("article", "neutral") for p in names.replace("-", " ").split()}


class Model(NamedTuple):
    """Weights of both directions side by side: hashed inputs and measures to gates, states to gates, states to the label."""

    inputs: np.ndarray  # (PATH_DIMS + WORD_DIMS + MEASURES, 2 * 4 * HIDDEN)
    forward: np.ndarray  # (HIDDEN, 4 * HIDDEN)
    backward: np.ndarray
    out: np.ndarray  # (2 * HIDDEN + 1,)


class Sequence(NamedTuple):
    """Hashed features of one page's blocks: which block has which, and how much."""

    block: np.ndarray
    feature: np.ndarray
    amount: np.ndarray
    measures: np.ndarray  # (blocks, MEASURES)


class Hasher:
    """Buckets of names; the buckets of common names are kept."""

    LIMIT = 200_000

    def __init__(self):
        self.known: dict[str, int] = {}

    def path(self, name: str) -> int:
        return self._of(name, PATH_DIMS, 0)

    def word(self, name: str) -> int:
        return self._of("w " + name, WORD_DIMS, PATH_DIMS)

    def _of(self, name: str, size: int, first: int) -> int:
        at = self.known.get(name)
        if at is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            at = self.known[name] = first + zlib.crc32(name.encode("utf-8", "surrogatepass")) % size
        return at


def sequence(page: list[Block], hasher: Hasher) -> Sequence:
    """What the network reads of a page. All words of a block count, each by its share."""
    owner, feature, amount = [], [], []
    measures = np.zeros((len(page), MEASURES), np.float32)
    before = None
    for i, block in enumerate(page):
        path = {hasher.path(p) for p in block.path}
        path.add(hasher.path(f"leaf {block.leaf}"))
        if len(block.path) > 1:
            path.add(hasher.path(f"last {block.path[-1]}"))
        words = block.text.lower().split()
        shares: dict[int, float] = {}
        for w in words:
            at = hasher.word(w)
            shares[at] = shares.get(at, 0.0) + 1 / len(words)
        owner += [i] * (len(path) + len(shares))
        feature += [*sorted(path), *shares]
        amount += [1.0] * len(path) + list(shares.values())
        n = len(block.text)
        measures[i] = (
            1.0, np.log1p(len(words)) / 5, np.log1p(n) / 8, block.link_chars / n, block.text[-1] in ".!?", block.text[0].isupper(),
            sum(c.isdigit() for c in block.text[:200]) / min(n, 200), block.path == before, len(block.path) / 20, i == 0,
        )
        before = block.path
    return Sequence(np.array(owner, np.int64), np.array(feature, np.int64), np.array(amount, np.float32), measures)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Batch:
    """Pages side by side, padded behind their last block; ``place`` is where a block stands."""

    def __init__(self, pages: list[Sequence]):
        sizes = np.array([len(p.measures) for p in pages])
        first = np.concatenate([[0], np.cumsum(sizes)])
        self.length, self.pages, self.sizes = int(sizes.max(initial=0)), len(pages), sizes
        self.row = np.repeat(np.arange(len(pages)), sizes)
        self.step = np.arange(first[-1]) - first[self.row]
        self.block = np.concatenate([p.block + first[i] for i, p in enumerate(pages)])
        self.feature = np.concatenate([p.feature for p in pages])
        self.amount = np.concatenate([p.amount for p in pages])
        self.measures = np.concatenate([p.measures for p in pages])
        self.inside = np.arange(self.length)[:, None] < sizes
        # reversed within each page
        self.back = sizes[self.row] - 1 - self.step

    def matrix(self, low: int = 0, high: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Features that occur in the blocks low to high, and the amounts of them in each block."""
        high = len(self.measures) if high is None else high
        a, b = np.searchsorted(self.block, [low, high])
        seen, at = np.unique(self.feature[a:b], return_inverse=True)
        amounts = np.bincount((self.block[a:b] - low) * len(seen) + at, self.amount[a:b], (high - low) * len(seen))
        return seen, amounts.reshape(high - low, len(seen)).astype(np.float32)

    def gates(self, model: Model, size: int = 2048) -> np.ndarray:
        parts = [np.zeros((0, model.inputs.shape[1]), np.float32)]
        for low in range(0, len(self.measures), size):
            seen, amounts = self.matrix(low, min(low + size, len(self.measures)))
            parts.append(amounts @ model.inputs[seen] + self.measures[low : low + size] @ model.inputs[-MEASURES:])
        return np.concatenate(parts)

    def spread(self, values: np.ndarray, step: np.ndarray) -> np.ndarray:
        out = np.zeros((self.length, self.pages, values.shape[1]), np.float32)
        out[step, self.row] = values
        return out


def lstm(gates: np.ndarray, weights: np.ndarray, keep: bool = False):
    """Hidden states of (steps, pages) for gate inputs in the order input, forget, output, candidate; with ``keep`` also what gradients need."""
    steps, pages, width = gates.shape
    hidden = width // 4
    h, c = np.zeros((pages, hidden), np.float32), np.zeros((pages, hidden), np.float32)
    out = np.zeros((steps, pages, hidden), np.float32)
    trace = []
    for t in range(steps):
        z = gates[t] + h @ weights
        gate = _sigmoid(z[:, : 3 * hidden])
        i, f, o = gate[:, :hidden], gate[:, hidden : 2 * hidden], gate[:, 2 * hidden :]
        g = np.tanh(z[:, 3 * hidden :])
        if keep:
            trace.append((gate, g, c, h))
        c = f * c + i * g
        h = o * np.tanh(c)
        out[t] = h
    return (out, trace) if keep else out


def lstm_back(d_out: np.ndarray, trace: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs and of the weights, from those of the hidden states."""
    steps, pages, hidden = d_out.shape
    d_gates = np.zeros((steps, pages, 4 * hidden), np.float32)
    d_weights = np.zeros_like(weights)
    dh, dc = np.zeros((pages, hidden), np.float32), np.zeros((pages, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        gate, g, before, h = trace[t]
        i, f, o = gate[:, :hidden], gate[:, hidden : 2 * hidden], gate[:, 2 * hidden :]
        c = np.tanh(f * before + i * g)
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - c * c)
        d = d_gates[t]
        d[:, :hidden], d[:, hidden : 2 * hidden], d[:, 2 * hidden : 3 * hidden] = dc * g, dc * before, dh * c
        d[:, : 3 * hidden] *= gate * (1 - gate)
        d[:, 3 * hidden :] = dc * i * (1 - g * g)
        d_weights += h.T @ d
        dh, dc = d @ weights.T, dc * f
    return d_gates, d_weights


def scores(model: Model, pages: list[Sequence]) -> np.ndarray:
    """Probability of article of every block, page after page."""
    batch = Batch(pages)
    if not len(batch.measures):
        return np.zeros(0, np.float32)
    gates = batch.gates(model)
    half = gates.shape[1] // 2
    ahead = lstm(batch.spread(gates[:, :half], batch.step), model.forward)
    back = lstm(batch.spread(gates[:, half:], batch.back), model.backward)
    states = np.concatenate([ahead[batch.step, batch.row], back[batch.back, batch.row]], 1)
    return _sigmoid(states @ model.out[:-1] + model.out[-1])


def gradients(model: Model, pages: list[Sequence], labels: np.ndarray) -> tuple[float, dict]:
    """Mean loss of the blocks and its gradients; those of the inputs only for the features that occur."""
    batch = Batch(pages)
    seen, amounts = batch.matrix()
    gates = amounts @ model.inputs[seen] + batch.measures @ model.inputs[-MEASURES:]
    half = gates.shape[1] // 2
    ahead, trace1 = lstm(batch.spread(gates[:, :half], batch.step), model.forward, True)
    back, trace2 = lstm(batch.spread(gates[:, half:], batch.back), model.backward, True)
    states = np.concatenate([ahead[batch.step, batch.row], back[batch.back, batch.row]], 1)
    p = _sigmoid(states @ model.out[:-1] + model.out[-1])
    loss = float(-np.mean(np.log(np.where(labels > 0, p, 1 - p) + 1e-9)))
    miss = ((p - labels) / len(labels)).astype(np.float32)
    d_states = miss[:, None] * model.out[:-1]
    hidden = d_states.shape[1] // 2
    d_gates1, d_forward = lstm_back(batch.spread(d_states[:, :hidden], batch.step), trace1, model.forward)
    d_gates2, d_backward = lstm_back(batch.spread(d_states[:, hidden:], batch.back), trace2, model.backward)
    d_gates = np.concatenate([d_gates1[batch.step, batch.row], d_gates2[batch.back, batch.row]], 1)
    return loss, {
        "seen": np.concatenate([seen, np.arange(len(model.inputs) - MEASURES, len(model.inputs))]),
        "inputs": np.concatenate([amounts.T @ d_gates, batch.measures.T @ d_gates]),
        "forward": d_forward, "backward": d_backward, "out": np.append(states.T @ miss, miss.sum()).astype(np.float32),
    }


def initial_model(seed: int = 7, hidden: int = HIDDEN) -> Model:
    pick = np.random.default_rng(seed)
    inputs = (pick.normal(size=(PATH_DIMS + WORD_DIMS + MEASURES, 8 * hidden)) * 0.01).astype(np.float32)
    # the first measure is one: gates that forget little at first
    inputs[-MEASURES, hidden : 2 * hidden] = inputs[-MEASURES, 5 * hidden : 6 * hidden] = 1
    square = [(pick.normal(size=(hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32) for _ in range(2)]
    return Model(inputs, *square, (pick.normal(size=2 * hidden + 1) * 0.1).astype(np.float32))


def fit(examples: list[tuple[Sequence, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, batch: int = 16, seed: int = 7) -> Model:
    """Gradient steps (Adam) over batches of pages of about equal length."""
    model = initial_model(seed)
    pick = random.Random(seed)
    examples = sorted((e for e in examples if len(e[1])), key=lambda e: len(e[1]))
    groups = [examples[i : i + batch] for i in range(0, len(examples), batch)]
    mean = {k: np.zeros_like(v) for k, v in model._asdict().items()}
    square = {k: np.zeros_like(v) for k, v in model._asdict().items()}
    step, total = 0, epochs * len(groups)
    for _ in range(epochs):
        pick.shuffle(groups)
        for group in groups:
            step += 1
            _, found = gradients(model, [s for s, _ in group], np.concatenate([y for _, y in group]).astype(np.float32))
            pace = rate * min(1.0, 2 * (1 - step / (total + 1)))
            size = np.sqrt(sum(float((found[k] ** 2).sum()) for k in mean))
            for name, values in model._asdict().items():
                at = found["seen"] if name == "inputs" else slice(None)
                d = found[name] * min(1.0, 1 / (size + 1e-9)) + 1e-6 * values[at]
                mean[name][at] = 0.9 * mean[name][at] + 0.1 * d
                square[name][at] = 0.99 * square[name][at] + 0.01 * d * d
                values[at] -= pace * (mean[name][at] / (1 - 0.9**step)) / (np.sqrt(square[name][at] / (1 - 0.99**step)) + 1e-6)
    return model


def told(page: list[Block]) -> np.ndarray | None:
    """Labels that a page's own elements tell: article or main, but nothing inside that is named otherwise. None: it does not tell."""
    inside = [any(p in ("article", "main") for p in b.path) for b in page]
    if not any(inside) or all(inside):
        return None
    other = {"nav", "aside", "footer", "form", "header", "button", "dialog", *(f".{n}" for n in _BOILERPLATE)}
    return np.array([i and not other & set(b.path[_last_main(b.path) :]) for i, b in zip(inside, page, strict=True)], np.float32)


def _last_main(path: tuple[str, ...]) -> int:
    return max(i for i, p in enumerate(path) if p in ("article", "main"))


def _material(page: list[Block]) -> Material | None:
    """Title and paragraphs of a page, as far as they can be told: marked ones, else what reads like prose."""
    labels = told(page)
    if labels is None:
        chosen = [b for b in page if b.leaf == "p" and not b.link_chars and len(b.text.split()) >= 8]
    else:
        chosen = [b for b, y in zip(page, labels, strict=True) if y]
    title = next((b.text for b in chosen if b.leaf in ("h1", "h2")), "")
    paragraphs = [b.text for b in chosen if b.text != title]
    return Material(title, paragraphs) if paragraphs else None


#: Where the pages hold no prose at all.
_FILLER = Material("A title", ["Some words in a row make a sentence.", "Another paragraph follows, a little longer than the first one."])


def rendered(materials: list[Material], count: int, seed: int) -> Iterator[tuple[list[Block], np.ndarray]]:
    """Random pages around the materials, with the label of every block."""
    pick = random.Random(seed)
    materials = materials or [_FILLER]
    for i in range(count):
        own = materials[i % len(materials)]
        at = pick.randrange(len(own.paragraphs))
        part = Material(own.title, own.paragraphs[at : at + pick.randrange(1, 16)])
        page = blocks(Page(pick, part, materials).html())
        labels = np.array([MARK in b.text for b in page], np.float32)
        clean = [b._replace(text=b.text.replace(MARK, "") or "-") for b in page]
        yield clean[:SEGMENT], labels[:SEGMENT]


def train(pages: DataFrame, limit: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS, count: int = RENDERED, epochs: int = EPOCHS) -> Model:
    """Fit on at most ``limit`` pages of at most ``chars`` characters, chosen by a hash, and ``count`` layouts around their text.

    Training sequences are cut after ``SEGMENT`` blocks. An empty table still gives a model, from filler text.
    """
    usable = pages.where(F.length("html").between(1, chars)).select(F.xxhash64("html").alias("h"), "html")
    # the hashes first, so that no task sends pages that are not chosen; equal pages count once
    hashes = [r.h for r in usable.select("h").distinct().orderBy("h").limit(limit).collect()]
    rows = usable.where(F.col("h").isin(hashes)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if hashes else []
    parsed = [blocks(r.html) for r in rows]
    hasher = Hasher()
    examples = []
    for page in parsed:
        labels = told(page)
        if labels is not None:
            examples.append((sequence(page[:SEGMENT], hasher), labels[:SEGMENT]))
    materials = [m for m in map(_material, parsed) if m]
    examples += [(sequence(page, hasher), labels) for page, labels in rendered(materials, count, seed=11)]
    return fit(examples, epochs)


def article_blocks(pages: list[list[Block]], model: Model, hasher: Hasher) -> list[np.ndarray]:
    """For each page, which blocks are article. Pages of about equal length are read together."""
    labels: list[np.ndarray] = [np.zeros(len(p), bool) for p in pages]
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        take = 1
        while at + take < len(order) and take < _PAGES_AT_ONCE and (take + 1) * len(pages[order[at + take]]) <= _BLOCKS_AT_ONCE:
            take += 1
        chosen = order[at : at + take]
        found = scores(model, [sequence(pages[i], hasher) for i in chosen]) >= 0.5
        ends = np.cumsum([len(pages[i]) for i in chosen])
        for i, part in zip(chosen, np.split(found, ends[:-1]), strict=True):
            labels[i] = part
        at += take
    return labels


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept) for every row: the article's blocks, two line ends between them.

    Nulls: a null html is an empty page with empty text; null ids and urls are returned as they are. Repeated rows get equal texts. Long
    pages are read whole. Further columns are not read, whatever their names. An empty table gives no rows.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            column = batch.column(2)
            for low in range(0, batch.num_rows, 256):
                part = [blocks(h) for h in column.slice(low, 256).to_pylist()]
                kept = article_blocks(part, model, hasher)
                texts = ["\n\n".join(b.text for b, y in zip(page, labels, strict=True) if y) for page, labels in zip(part, kept, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, 256), batch.column(1).slice(low, 256), pa.array([t.encode("utf-8", "replace") for t in texts], pa.binary()).cast(pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in part], pa.int64()),
                     pa.array([int(k.sum()) for k in kept], pa.int64())],
                    ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint, n_blocks bigint, n_kept bigint"
    )
