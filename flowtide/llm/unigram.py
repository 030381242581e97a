"""SentencePiece encoding and decoding with a unigram model: Viterbi over a double-array trie of pieces.

Spaces become the marker U+2581 and one marker is put before a text. The best segmentation has the largest sum of piece scores; a
character that no piece covers costs ten less than the worst piece and is written as its UTF-8 bytes. No piece has the marker
behind another character, so a text falls into independent chunks (markers, then other characters). The
distinct chunks of a block of texts are segmented together, one array step per byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.storage import from_row, whole_row

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
BLOCK_CHARS = 2 << 20
_LONG = 96
_MARK = MARK.encode()


class Trie(NamedTuple):
    """Double array: the child of node s by byte c is base[s] + c, if check there is s."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # number of the piece that ends in a node, or -1


def build_trie(pieces: dict[bytes, int]) -> Trie:
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for text, number in pieces.items():
        node = 0
        for byte in text:
            node = children[node].setdefault(byte, len(children))
            if node == len(children):
                children.append({})
        ends[node] = number
    size = 2 * len(children) + 1024
    base, check, piece = [0] * size, [-1] * size, [-1] * size
    place, free, tail = {0: 0}, 257, 257  # below that, a base could become negative
    check[0] = 0
    for node, below in enumerate(children):  # parents come before their children
        if not below:
            continue
        codes = sorted(below)
        while check[free] >= 0:
            free += 1
            if free + 512 > size:
                base += [0] * size
                check += [-1] * size
                piece += [-1] * size
                size *= 2
        # a single child fills the first gap; several look near the end only, where gaps are wide
        at = free if len(codes) == 1 else max(free, tail - 1024)
        while any(check[at - codes[0] + c] >= 0 for c in codes):
            at += 1
            if at + 512 > size:
                base += [0] * size
                check += [-1] * size
                piece += [-1] * size
                size *= 2
        start, here = at - codes[0], place[node]
        base[here] = start
        for code in codes:
            check[start + code] = here
            place[below[code]] = start + code
            piece[start + code] = ends.get(below[code], -1)
        tail = max(tail, start + codes[-1])
    return Trie(*(np.array(a + [0 if a is base else -1] * 256, np.int32) for a in (base, check, piece)))


class Model(NamedTuple):
    trie: Trie
    scores: np.ndarray
    unknown: float
    bytes_: np.ndarray  # ids of the 256 byte pieces
    blob: np.ndarray  # bytes of all pieces, for decoding
    offsets: np.ndarray
    longest: int


def make_model(pieces: list[tuple[str, float, str]]) -> Model:
    """From (piece, score, kind) by id; kinds are normal, byte and control, as in the model file."""
    normal = {p.encode(): i for i, (p, _, kind) in enumerate(pieces) if kind == "normal" and p}
    if any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind == "normal"):
        raise ValueError("a piece has the white-space marker behind another character")
    scores = np.array([s for _, s, _ in pieces], float)
    texts = [bytes([int(p[3:5], 16)]) if kind == "byte" else p.encode() if kind == "normal" else b"" for p, _, kind in pieces]
    at = np.full(256, -1, np.int32)
    for i, (p, _, kind) in enumerate(pieces):
        if kind == "byte":
            at[int(p[3:5], 16)] = i
    if (at < 0).any():
        raise ValueError("the model has no byte pieces")
    unknown = min(scores[i] for i in normal.values()) - UNKNOWN_PENALTY
    offsets = np.cumsum([0, *map(len, texts)])
    return Model(
        build_trie(normal), scores, unknown, at, np.frombuffer(b"".join(texts), np.uint8), offsets, max(map(len, normal))
    )


def load_pieces(path: str = MODEL, ranks: bool = True) -> list[tuple[str, float, str]]:
    """Pieces and log scores of a SentencePiece model file.

    With ``ranks`` the file's scores are negative merge ranks, as a BPE file has them, and become log probabilities by Zipf's
    law: -log(2 + rank); pieces the file pushes far below all others rank last. Else they are log scores already.
    """
    from sentencepiece import SentencePieceProcessor

    file = SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if file.is_byte(i) else "control" if file.is_control(i) or file.is_unknown(i) else "normal"
    size = file.get_piece_size()
    score = (lambda s: -math.log(2 + min(-s, size))) if ranks else (lambda s: s)
    return [(file.id_to_piece(i), score(file.get_score(i)), kind(i)) for i in range(size)]


def load_model(path: str = MODEL, ranks: bool = True) -> Model:
    return make_model(load_pieces(path, ranks))


def _char_length(first: np.ndarray) -> np.ndarray:
    return 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)


def segment(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and where each begins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.zeros(len(texts), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    edges = [0, 4, 8, 12, 16, 24, 32, 48, 64, _LONG]
    for low, high in zip(edges, edges[1:], strict=False):
        rows = np.flatnonzero((sizes > low) & (sizes <= high))
        if len(rows):
            owner, ids = _segment_short(model, [texts[r] for r in rows], sizes[rows], high)
            parts.append((rows[owner], ids))
    for row in np.flatnonzero(sizes > _LONG):
        ids = _segment_long(model, texts[row])
        parts.append((np.full(len(ids), row), ids))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    owner, ids = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(owner, kind="stable")
    np.add.at(counts, owner, 1)
    return ids[order].astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


def _segment_short(model: Model, texts: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts at once: the outer loops run over byte positions only."""
    n = len(texts)
    grid = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(n, width).astype(np.int32)
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    came = np.zeros((n, width + 1), np.int32)
    by = np.full((n, width + 1), -1, np.int32)
    base, check, piece = model.trie
    for i in range(width):
        begun = np.flatnonzero((best[:, i] > -np.inf) & (sizes > i))
        if not len(begun):
            continue
        step = _char_length(grid[begun, i])
        single = np.zeros(len(begun), bool)
        live, node = np.arange(len(begun)), np.zeros(len(begun), np.int32)
        for j in range(i, min(width, i + model.longest)):
            inside = sizes[begun[live]] > j
            live, node = live[inside], node[inside]
            to = base[node] + grid[begun[live], j]
            found = check[to] == node
            live, node = live[found], to[found]
            if not len(live):
                break
            number = piece[node]
            ends = np.flatnonzero(number >= 0)
            at, number = live[ends], number[ends]
            single[at[step[at] == j + 1 - i]] = True
            rows = begun[at]
            score = best[rows, i] + model.scores[number]
            better = score > best[rows, j + 1]
            rows = rows[better]
            best[rows, j + 1], came[rows, j + 1], by[rows, j + 1] = score[better], i, number[better]
        alone = np.flatnonzero(~single)
        rows, end = begun[alone], i + step[alone]
        score = best[rows, i] + model.unknown
        better = score > best[rows, end]
        rows, end = rows[better], end[better]
        best[rows, end], came[rows, end], by[rows, end] = score[better], i, -1
    rows, at, left = np.arange(n), sizes.copy(), np.zeros(n, np.int64)
    out = []
    while len(rows):
        number, start = by[rows, at], came[rows, at]
        left = np.where((left == 0) & (number < 0), at - start, left)
        raw = left > 0
        out.append((rows, np.where(raw, model.bytes_[grid[rows, at - 1]], number)))
        at = np.where(raw, at - 1, start)
        left = np.maximum(left - 1, 0)
        more = at > 0
        rows, at, left = rows[more], at[more], left[more]
    owner, ids = (np.concatenate(p[::-1]) for p in zip(*out, strict=True))
    order = np.argsort(owner, kind="stable")
    return owner[order], ids[order]


def _segment_long(model: Model, text: bytes) -> np.ndarray:
    """One long text, byte by byte."""
    base, check, piece = model.trie
    n = len(text)
    best, came, by = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    scores = model.scores
    for i in range(n):
        here = best[i]
        if here == -np.inf:
            continue
        step, single, node = int(_char_length(np.array(text[i]))), False, 0
        for j in range(i, n):
            to = int(base[node]) + text[j]
            if check[to] != node:
                break
            node = to
            number = int(piece[node])
            if number >= 0:
                single |= j + 1 - i == step
                score = here + scores[number]
                if score > best[j + 1]:
                    best[j + 1], came[j + 1], by[j + 1] = score, i, number
        if not single and here + model.unknown > best[i + step]:
            best[i + step], came[i + step], by[i + step] = here + model.unknown, i, -1
    ids, at = [], n
    while at:
        start = came[at]
        ids += [by[at]] if by[at] >= 0 else [int(model.bytes_[b]) for b in reversed(text[start:at])]
        at = start
    return np.array(ids[::-1], np.int32)


def _gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of ``flat`` named by ``which``, one after the other, and their lengths."""
    lengths = np.diff(offsets)[which]
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[which] - (ends - lengths), lengths)
    return flat[at], lengths


def encode(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and the offsets of each; a null or empty text has none."""
    number: dict[str, int] = {}
    which: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            # a chunk begins where a marker follows another character; a line end is in no piece and cuts too
            parts = f" {text}".replace(MARK, " ").split(" ")
            before = len(which)
            extra = ""
            for part in parts[1:]:
                if part:
                    which.append(number.setdefault(f"{extra} {part}" if extra else part, len(number)))
                    extra = ""
                else:
                    extra += " "
            if extra:
                which.append(number.setdefault(extra, len(number)))
            sizes[i] = len(which) - before
    spelled = [(c if c[0] == " " else f" {c}").replace(" ", MARK).encode() for c in number]
    flat, offsets = segment(model, spelled)
    ids, lengths = _gather(flat, offsets, np.array(which, np.int64))
    sums = np.concatenate([[0], np.cumsum(lengths)])
    return ids, sums[np.concatenate([[0], np.cumsum(sizes)])]


def decode(model: Model, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """UTF-8 texts: byte pieces as bytes, markers as spaces, without the first marker."""
    flat, lengths = _gather(model.blob, model.offsets, ids)
    at = np.concatenate([[0], np.cumsum(lengths)])[offsets]
    raw = flat.tobytes()
    texts = (raw[a:b].replace(_MARK, b" ") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return [t[1:] if t[:1] == b" " else t for t in texts]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > BLOCK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encoded(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with token_ids, n_tokens and round_trip (decoding gives the text back); columns of these names are replaced.

    Nulls: a null text has null token_ids, 0 tokens and round_trip true. An empty text has no tokens. A text with the marker itself
    comes back with a space there, so its round_trip is false. Repeated rows are encoded alike.
    """
    added = ["token_ids", "n_tokens", "round_trip"]
    kept = [c for c in docs.columns if c not in added]
    given = docs.select("text", whole_row(docs, "text", *added))
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a few MB: the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, stop in _blocks(texts):
                part = texts[start:stop]
                ids, offsets = encode(own, part)
                back = decode(own, ids, offsets)
                same = [b == (t or "").encode() for b, t in zip(back, part, strict=True)]
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids), mask=pa.array([t is None for t in part])
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, stop - start).columns, lists, pa.array(np.diff(offsets)), pa.array(same)], ["text", "_row", *added]
                )

    from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType

    schema = type(docs.schema)(list(given.schema.fields))
    schema = schema.add("token_ids", ArrayType(IntegerType())).add("n_tokens", LongType()).add("round_trip", BooleanType())
    made = given.mapInArrow(run, schema)
    return made.select(*from_row(made, kept, text=F.col("text")), *added)


def token_report(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, round_trip and token_ids for every row; nulls, empty texts and repeated rows as in ``encoded``.

    An empty table gives no rows. Further columns are not read, whatever their names.
    """
    return encoded(docs.select("doc_id", "text"), model).select("doc_id", "n_tokens", "round_trip", F.col("token_ids"))
