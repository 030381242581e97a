"""Words of many texts at once: numpy arrays over the bytes of an Arrow string column.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``. Within a block of texts words are numbered exactly; between
tasks they go by two independent halves of a 128-bit hash, taken once for every distinct word. Hashes of sequences of words
are polynomials modulo the prime 2**61 - 1 at a random point, so no sequences collide by their structure.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_128_digest

CHUNK_BYTES = 2 << 20
_WORDS_AT_ONCE = 1 << 18
_PRIME = np.uint64((1 << 61) - 1)
_LOW30, _LOW31 = np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
_N1, _N30, _N31, _N61 = (np.uint64(n) for n in (1, 30, 31, 61))
_BASE = 0x1B873593CC9E2D51 % ((1 << 61) - 1)
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime."""
    x = (x & _PRIME) + (x >> _N61)
    return np.where(x >= _PRIME, x - _PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of reduced values modulo the prime, from halves of 31 bits."""
    a_high, a_low, b_high, b_low = a >> _N31, a & _LOW31, b >> _N31, b & _LOW31
    middle = a_low * b_high + a_high * b_low
    return _reduced((a_high * b_high << _N1) + (middle >> _N30) + ((middle & _LOW30) << _N31) + a_low * b_low)


class Powers:
    """Powers of a base and of its inverse modulo the prime, grown as needed."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, int(_PRIME))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            shifts = (np.full(1, pow(b, k, int(_PRIME)), np.uint64) for b in self.bases)
            self.up, self.down = (np.concatenate([v, times(v, s)]) for v, s in zip((self.up, self.down), shifts, strict=True))
        return self.up[:n], self.down[:n]


_POWERS = Powers(_BASE)


class Spans:
    """Hashes of any slices of an array of 64-bit values; each depends on the values in its slice only."""

    def __init__(self, values: np.ndarray):
        up, self.down = _POWERS.upto(len(values) + 1)
        terms = times(_reduced(values), up[: len(values)])
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)]) for part in (terms >> _N31, terms & _LOW31)]
        self.sums = _reduced(times(_reduced(sums[0]), np.full(1, 1 << 31, np.uint64)) + _reduced(sums[1]))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inside = times(_reduced(self.sums[ends] + (_PRIME - self.sums[starts])), self.down[starts])
        return mix(inside ^ mix((ends - starts).astype(np.uint64)))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(values).hashes(starts, ends)


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # of the texts in data
    starts: np.ndarray  # of the words in data
    ends: np.ndarray
    doc: np.ndarray  # text number of each word
    first: np.ndarray  # number of the first word of each text, and the total

    def numbered(self) -> tuple[np.ndarray, list[bytes]]:
        """A number for every word, equal for equal words only, and the distinct words by their number."""
        known: dict[bytes, int] = {}
        ids = np.zeros(len(self.starts), np.int64)
        for first, last in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            for low in range(first, last, _WORDS_AT_ONCE):
                high = min(low + _WORDS_AT_ONCE, last)
                found = self.data[self.starts[low] : self.ends[high - 1]].tobytes().split()
                ids[low:high] = [known.setdefault(w, len(known)) for w in found]
        return ids, list(known)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit names of every word, the same in every task."""
        ids, distinct = self.numbered()
        digests = np.frombuffer(b"".join(map(xxh3_128_digest, distinct)), np.uint64).reshape(-1, 2)
        return digests[ids, 0], digests[ids, 1]

    def per_doc(self, per_word: np.ndarray) -> np.ndarray:
        """Sums of a value per word, by text."""
        sums = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])
        return sums[self.first[1:]] - sums[self.first[:-1]]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    low, high = (int(at[0]), int(at[-1])) if len(at) else (0, 0)
    body = np.frombuffer(data, np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
    return body, at - low


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    space = SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[0] = cut[n] = True
    before = np.ones(n + 1, bool)
    before[1:] = space
    after = np.ones(n + 1, bool)
    after[:n] = space
    starts = np.flatnonzero(~space & (before[:-1] | cut[:-1]))
    ends = np.flatnonzero(~space & (after[1:] | cut[1:])) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(starts, offsets, side="left")
    return Words(data, offsets, starts, ends, doc, first)


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts in runs of about ``size`` bytes: first and last row, bytes, offsets."""
    data, offsets = buffers(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        stop = min(max(stop, row + 1), n)
        low, high = offsets[row], offsets[stop]
        yield row, stop, data[low:high], offsets[row : stop + 1] - low
        row = stop


def repeats(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, how many items have the same (group, value), and whether an earlier one has it.

    Both are small whole numbers, of groups and of distinct values.
    """
    if not len(value):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = group.astype(np.int64) * (int(value.max()) + 1) + value
    _, first, at, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return count[at], first[at] != np.arange(len(key))


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for every pair of small numbers, equal for equal pairs only."""
    if not len(left):
        return np.zeros(0, np.int64)
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]
