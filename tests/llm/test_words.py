import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from flowtide.llm import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x85\xa0é日", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes_follow_the_definition(texts):
    data, offsets = words.buffers(pa.array(texts, pa.string()))
    found = words.words_of(data, offsets)
    want = [(d, w) for d, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    got = [(d, bytes(data[a:b]).decode()) for d, a, b in zip(found.doc, found.starts, found.ends, strict=True)]
    assert got == want
    ids, distinct = found.numbered()
    assert [distinct[i].decode() for i in ids] == [w for _, w in want] and len(set(distinct)) == len(distinct)
    for names in found.names():
        assert len(set(names.tolist())) == len({w for _, w in want})
    assert np.diff(found.first).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_chunks_keep_texts_whole_and_sliced_columns_work():
    column = pa.array(["x", "first text", None, "", "b" * 50, "last"]).slice(1)
    parts = [(a, b, bytes(data)) for a, b, data, _ in words.chunks(column, size=12)]
    assert b"".join(p for *_, p in parts) == b"first text" + b"b" * 50 + b"last"
    assert [p[0] for p in parts][0] == 0 and parts[-1][1] == 5
    assert list(words.chunks(pa.array([], pa.string()))) == []


def test_repeats():
    group, value = np.array([0, 0, 0, 1, 1]), np.array([5, 7, 5, 5, 5])
    count, again = words.repeats(group, value)
    assert count.tolist() == [2, 1, 2, 2, 2] and again.tolist() == [False, False, True, False, True]
    assert words.paired(np.array([1, 1, 2]), np.array([3, 4, 3])).tolist() == [0, 1, 2]


def thue_morse(k):
    bits = [0]
    for _ in range(k):
        bits += [1 - b for b in bits]
    return bits


def test_spans_are_polynomials_and_tell_thue_morse_apart():
    pick = np.random.default_rng(0)
    values = pick.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    prime = (1 << 61) - 1
    spans = words.Spans(values)
    starts, ends = pick.integers(0, 30, 40), pick.integers(30, 61, 40)
    for a, b, h in zip(starts, ends, spans.hashes(starts, ends), strict=True):
        want = sum(int(v) % prime * pow(words._BASE, i, prime) for i, v in enumerate(values[a:b])) % prime
        assert h == words.mix(np.array([want], np.uint64) ^ words.mix(np.array([b - a], np.uint64)))[0]
    one = np.array(thue_morse(11), np.uint64) + np.uint64(7)
    both = np.concatenate([one, np.uint64(15) - one])
    found = words.span_hashes(both, np.array([0, 2048]), np.array([2048, 4096]))
    assert found[0] != found[1]
