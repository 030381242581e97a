import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_docs import docs_of  # noqa: F401
from flowtide.llm import unigram
from flowtide.llm.unigram import MARK


@pytest.fixture(scope="module")
def model():
    return unigram.load_model()


@pytest.fixture(scope="module")
def library():
    """The same pieces and log scores as a unigram model of the SentencePiece library."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor

    made = proto.ModelProto()
    made.ParseFromString(open(unigram.MODEL, "rb").read())
    made.trainer_spec.model_type = 1
    for piece, (_, score, _) in zip(made.pieces, unigram.load_pieces(), strict=True):
        piece.score = score
    return SentencePieceProcessor(model_proto=made.SerializeToString())


def ids_of(model, text):
    ids, offsets = unigram.encode(model, [text])
    assert offsets.tolist() == [0, len(ids)]
    return ids.tolist()


def score(model, library, ids, text):
    return sum(model.scores[i] for i in ids if not library.is_byte(i))


def test_equals_the_library(model, library, spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [r.text for r in rows] + ["a", " a", "a ", "  a   b  ", "\n\n", "x\ty", "日本語 ☃ 🙂🙂", "é" * 70, "z" * 500, "   ", "12345"]
    ids, offsets = unigram.encode(model, texts)
    for i, text in enumerate(texts):
        own, other = ids[offsets[i] : offsets[i + 1]].tolist(), library.encode(text)
        if own != other:  # the library adds up in single precision: only exact ties may differ
            assert np.isclose(score(model, library, own, text), score(model, library, other, text), rtol=1e-5)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet=" ab\n☃🙂", max_size=150)), max_size=5))
def test_round_trip(texts):
    own = unigram.load_model() if not hasattr(test_round_trip, "m") else test_round_trip.m
    test_round_trip.m = own
    ids, offsets = unigram.encode(own, texts)
    back = unigram.decode(own, ids, offsets)
    assert [b.decode() for b in back] == [(t or "").replace(MARK, " ") for t in texts]


def small_model():
    pieces = [("<unk>", 0.0, "control"), *((f"<0x{b:02X}>", 0.0, "byte") for b in range(256))]
    normal = {MARK: -4.0, "a": -3.0, "b": -3.5, "ab": -4.0, MARK + "a": -4.5, "ba": -5.0, "aba": -7.2, "ä": -6.0, MARK * 2: -6.5}
    return unigram.make_model(pieces + [(p, s, "normal") for p, s in normal.items()]), normal


def test_equals_enumeration_of_all_segmentations():
    model, normal = small_model()
    worst = min(normal.values()) - unigram.UNKNOWN_PENALTY

    def best(text):
        table = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                part = text[start:end]
                value = normal.get(part, worst if len(part) == 1 else -np.inf)
                table[end] = max(table[end], table[start] + value)
        return table[-1]

    number = {257 + i: p for i, p in enumerate(normal)}
    for text in ("ab", "abab ba", "  aba  ab", "äb☃a", "aab" * 50, "☃☃"):
        ids = ids_of(model, text)
        spelled = MARK + text.replace(" ", MARK)
        got = sum(normal[number[i]] for i in ids if i in number)
        got += worst * sum(c not in normal for c in spelled)
        assert np.isclose(got, best(spelled))
        assert unigram.decode(model, np.array(ids), np.array([0, len(ids)]))[0].decode() == text


def test_trie_holds_exactly_the_pieces():
    model, normal = small_model()
    base, check, piece = model.trie
    for word in ("a", "aba", "abab", "x", MARK + "a", MARK * 2, MARK * 3):
        node = 0
        for byte in word.encode():
            to = base[node] + byte
            node = to if check[to] == node else None
            if node is None:
                break
        assert (node is not None and piece[node] >= 0) == (word in normal)


def test_table_with_nulls_repeats_and_clashing_names(spark, docs_of, model):
    docs = docs_of((1, "The cat\n"), (1, "The cat\n"), (None, None), (2, ""), (3, f"a{MARK}b"), (4, "long " * 5000))
    docs = docs.withColumnRenamed("rank", "n_tokens")
    rows = unigram.encoded(docs, model).collect()
    assert len(rows) == 6 and rows[0].__fields__ == [*[c for c in docs.columns if c != "n_tokens"], "token_ids", "n_tokens", "round_trip"]
    got = sorted((r.doc_id or 0, r.n_tokens > 0, r.round_trip, r.token_ids is None) for r in rows)
    assert got == [(0, False, True, True), (1, True, True, False), (1, True, True, False), (2, False, True, False), (3, True, False, False), (4, True, True, False)]
    assert unigram.encoded(docs.limit(0), model).count() == 0


def test_models_it_cannot_segment_are_refused():
    with pytest.raises(ValueError, match="byte pieces"):
        unigram.make_model([("a", -1.0, "normal")])
    with pytest.raises(ValueError, match="marker"):
        unigram.make_model([(f"a{MARK}b", -1.0, "normal")])
