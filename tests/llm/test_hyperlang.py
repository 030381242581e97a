import random
import tracemalloc
import zlib

import numpy as np
import pytest

from llm_docs import docs_of  # noqa: F401
from flowtide.llm import hyperlang

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["žo", "ął", "ęść", "ry"]}


def prose(lang, pick, n=40):
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark, docs_of):
    pick = random.Random(1)
    rows = [(i, prose(lang, pick), lang) for i, lang in enumerate(list(SYLLABLES) * 20)]
    return hyperlang.train(docs_of(*rows, (900, None, "aa"), (901, "no letters: 123", "bb"), (902, "text", None)))


def test_bundles_are_sums_of_bound_triples():
    texts = ["Ab", "ab AB!ab", None, "", "é1é"]
    got = hyperlang.bundles(texts, hyperlang.Triples())
    letter = hyperlang._letter_vector

    def bound(a, b, c):
        return (np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)).astype(float)

    ab = bound(0, ord("a"), ord("b")) + bound(ord("a"), ord("b"), 0)
    assert np.array_equal(got[0], ab) and np.array_equal(got[1], 3 * ab)
    assert not got[2].any() and not got[3].any() and np.array_equal(got[4], 2 * bound(0, ord("é"), 0))


def test_slices_of_texts_and_of_triples_change_nothing(monkeypatch):
    pick = random.Random(6)
    texts = ["".join(chr(0x4E00 + pick.randrange(3000)) for _ in range(700)), prose("aa", pick), None, "x", prose("cc", pick, 100), "é"]
    whole = hyperlang.bundles(texts, hyperlang.Triples())
    kinds = hyperlang.variety(texts)
    for chars, triples in ((1, 4096), (7, 3), (100, 64)):
        monkeypatch.setattr(hyperlang, "SLICE_TRIPLES", triples)
        monkeypatch.setattr(hyperlang.triple_slices, "__defaults__", (chars,))
        assert np.array_equal(hyperlang.bundles(texts, hyperlang.Triples()), whole)
        assert np.allclose(hyperlang.variety(texts), kinds)


def test_memory_does_not_follow_a_long_text_of_many_letters(model):
    text = "".join(chr(0x4E00 + i % 20_000) if i % 3 else chr(0x3400 + i % 6000) for i in range(600_000))
    tracemalloc.start()
    names, _ = hyperlang.predict([text, "ka to mi ru"], model, hyperlang.Triples())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names[1] == "aa" and peak < 400e6


def test_unseen_texts_go_to_their_language(spark, docs_of, model):
    pick = random.Random(2)
    rows = [(i, prose(lang, pick, 12), lang) for i, lang in enumerate(list(SYLLABLES) * 10)]
    extra = [(50, None), (51, ""), (52, "12 %% 3"), (None, rows[0][1]), (0, rows[0][1])]
    found = hyperlang.identify(docs_of(*rows, *extra), model).collect()
    want = {i: lang for i, _, lang in rows}
    assert all(r.lang_pred == want.get(r.doc_id, "aa" if r.doc_id is None else "und") for r in found)
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in found)
    kept = hyperlang.accepted(docs_of(*rows, *extra), model, 0.2)
    assert kept.count() == len(rows) + 2 and kept.columns == docs_of((1, "")).columns


def test_short_and_repetitive_documents_stay_and_long_foreign_text_goes(spark, docs_of, model):
    pick = random.Random(3)
    short = [(n, prose(lang, pick, n % 5 + 1)) for n, lang in enumerate(list(SYLLABLES) * 20)]
    # letters of the learned languages that their words hardly ever join so
    short += [(100, "Avec."), (101, "Mo."), (102, "a"), (103, "Avec. " * 500), (104, prose("aa", pick, 30) + " avec" * 5000)]
    foreign = "".join(chr(0x4E00 + pick.randrange(3000)) for _ in range(400))
    docs = docs_of(*short, (200, foreign), (201, "12 %% 3"), (202, None))
    scores = {r.doc_id: r.score for r in hyperlang.identify(docs, model).collect()}
    assert sum(scores[i] < 0.2 for i, _ in short) >= 3 and scores[200] < 0.2
    assert sorted(r.doc_id for r in hyperlang.accepted(docs, model, 0.2).collect()) == [i for i, _ in short]


def test_variety_is_the_number_of_evenly_used_triples():
    assert hyperlang.variety(["ab", "ab ab ab", "", None]).tolist() == [2, 2, 0, 0]


def test_a_rare_language_is_learned_from_a_large_table(spark, docs_of):
    pick = random.Random(4)
    docs = docs_of(*[(i, prose("aa", pick, 5), "aa") for i in range(2000)], (5000, prose("bb", pick), "bb"), (5001, prose("cc", pick), "cc"))
    model = hyperlang.train(docs, limit=20)
    assert model.languages == ["aa", "bb", "cc"]
    found = hyperlang.identify(docs_of((1, prose("bb", pick)), (2, prose("cc", pick))), model).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "bb", 2: "cc"}


def test_nothing_to_learn_from(spark, docs_of):
    empty = hyperlang.train(docs_of((1, "text", None)))
    assert empty.languages == []
    rows = hyperlang.identify(docs_of((1, "text")), empty).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert hyperlang.identify(docs_of((1, "x")).limit(0), empty).count() == 0


def test_whole_query_equals_brute_force(spark):
    """Prototypes and cosines by plain sums over letters, for all documents."""
    from flowtide.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()

    def slow(text):
        signs = [ord(c) if c.isalpha() else 0 for c in (text or "").lower()]
        total = np.zeros(hyperlang.DIMENSIONS)
        letter = hyperlang._letter_vector
        for a, b, c in {(x, y, z) for x, y, z in zip([0, *signs], signs, [*signs[1:], 0], strict=False) if y}:
            times = sum((x, y, z) == (a, b, c) for x, y, z in zip([0, *signs], signs, [*signs[1:], 0], strict=False))
            total += times * (np.roll(letter(a), 2).astype(float) * np.roll(letter(b), 1) * letter(c))
        return total

    short = [r for r in docs if len(r.text or "") < 600]
    vectors = {r.doc_id: slow(r.text) for r in short}
    fast = hyperlang.bundles([r.text for r in docs], hyperlang.Triples())
    assert all(np.array_equal(fast[i], vectors[r.doc_id]) for i, r in enumerate(docs) if r.doc_id in vectors)
    sums = {}
    for r, v in zip(docs, fast, strict=True):
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and np.linalg.norm(v):
            sums[r.lang] = sums.get(r.lang, 0) + v / np.linalg.norm(v)
    langs = sorted(sums)
    prototypes = np.array([sums[x] / np.linalg.norm(sums[x]) for x in langs])
    want = {}
    for r, v in zip(docs, fast, strict=True):
        cosines = prototypes @ v / max(np.linalg.norm(v), 1e-12)
        want[r.doc_id] = (langs[int(cosines.argmax())], cosines.max().clip(0, 1)) if v.any() else ("und", 0.0)
    got = QUERIES["op7_hyperdimensional_language"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-4
