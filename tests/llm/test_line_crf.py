import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_docs import docs_of  # noqa: F401
from flowtide.llm import line_crf, words


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = set()
    for i in range(len(w) - 2):
        if triples[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é#|日\n\r\t ", max_size=40)), max_size=6))
def test_base_counts_equal_brute_force(texts):
    data, offsets = words.buffers(pa.array(texts, pa.string()))
    base = line_crf.lines_of(data, offsets).base
    got = list(zip(*[base[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], strict=True))
    assert [list(g) for g in got] == [brute(t) for t in texts]


def test_thue_morse_lines_are_different():
    bits = [0]
    for _ in range(10):
        bits += [1 - b for b in bits]
    text = "\n".join("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    base = line_crf.lines_of(*words.buffers(pa.array([text]))).base
    assert [int(base[c][0]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == brute(text)


def random_field(seed):
    pick = np.random.default_rng(seed)
    return line_crf.Field(pick.normal(size=line_crf.FEATURES), pick.normal(size=(2, 2)))


def path_score(field, codes, labels):
    gain = ((codes[:, None] >> np.arange(line_crf.FEATURES)) & 1) @ field.weights
    return sum(g for g, y in zip(gain, labels, strict=True) if y) + sum(field.transitions[a, b] for a, b in zip(labels, labels[1:], strict=False))


def test_viterbi_and_marginals_equal_enumeration():
    for seed in range(20):
        pick, field = np.random.default_rng(seed), random_field(seed)
        sizes = pick.integers(1, 7, 3)
        codes, doc = pick.integers(0, 1 << line_crf.FEATURES, sizes.sum()), np.repeat([0, 2, 3], sizes)
        got = line_crf.viterbi(field, codes, doc)
        for d in (0, 2, 3):
            mine, own = got[doc == d], codes[doc == d]
            scores = {y: path_score(field, own, y) for y in product((0, 1), repeat=len(own))}
            assert np.isclose(path_score(field, own, mine.astype(int).tolist()), max(scores.values()))
        own = codes[doc == 3]
        weight = {y: np.exp(path_score(field, own, y)) for y in product((0, 1), repeat=len(own))}
        total = sum(weight.values())
        gain = ((own[:, None] >> np.arange(line_crf.FEATURES)) & 1) @ field.weights
        node, edge = line_crf._marginals(gain[None], field.transitions, np.ones((1, len(own)), bool))
        assert np.allclose(node[0], [sum(v for y, v in weight.items() if y[i]) / total for i in range(len(own))])
        assert np.isclose(edge.sum(), len(own) - 1)


def test_fitted_field_tells_content_from_junk(spark, docs_of):
    pick = np.random.default_rng(0)
    prose = lambda: "\n".join("The " + " ".join(f"word{i}" for i in pick.integers(0, 5000, 12)) + "." for _ in range(12))
    junk = lambda: "\n".join(" | ".join(f"$$$nav{i}***" for i in pick.integers(0, 5000, 9)) for _ in range(12))
    rows = [(i, prose() if i % 2 else junk()) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    docs = docs_of(*rows, (900, None), (901, ""), (None, rows[1][1]), (1, rows[1][1]))
    field = line_crf.train_field(docs, labels)
    found = line_crf.quality_report(docs, field).collect()
    assert len(found) == 124
    for r in found:
        assert r.kept == (r.doc_id is None or (r.doc_id < 900 and r.doc_id % 2 == 1))
        assert r.base_failed == (r.doc_id in (900, 901))
    assert line_crf.quality_report(docs.limit(0), field).count() == 0
    # without labels of both kinds every line is content
    none = line_crf.train_field(docs, labels.limit(0))
    assert all(r.kept for r in line_crf.quality_report(docs_of(*rows), none).collect())


def test_marginal_likelihood_of_hidden_labels_equals_enumeration():
    """The gradient climbs the likelihood of the signs, summed over all labellings of short documents."""
    pick = np.random.default_rng(5)
    codes = [pick.integers(0, 1 << line_crf.FEATURES, n) for n in (1, 3, 4)]
    signs = [np.full(len(c), i % 2, np.int64) for i, c in enumerate(codes)]
    chains, trust = line_crf.Chains(codes, signs), np.array([0.2, 0.9])

    def likelihood(theta):
        field = line_crf.Field(theta[: line_crf.FEATURES], theta[line_crf.FEATURES :].reshape(2, 2))
        total = 0.0
        for c, z in zip(codes, signs, strict=True):
            paths = list(product((0, 1), repeat=len(c)))
            weights = np.exp([path_score(field, c, y) for y in paths])
            told = [np.prod([trust[a] if b else 1 - trust[a] for a, b in zip(y, z, strict=True)]) for y in paths]
            total += np.log(weights @ told / weights.sum())
        return total / chains.total

    theta = pick.normal(size=line_crf.FEATURES + 4)
    slope, _ = chains.gradient(theta, trust)
    for i in range(len(theta)):
        step = np.zeros_like(theta)
        step[i] = 1e-5
        assert np.isclose((likelihood(theta + step) - likelihood(theta - step)) / 2e-5, slope[i], atol=1e-6)


def test_prose_between_menu_lines_is_labelled_by_line(spark, docs_of):
    """Bad documents have lines of prose, good ones a few menus: labels change within a document, and the share decides."""
    pick = np.random.default_rng(1)
    prose = lambda: "The " + " ".join(f"word{i}" for i in pick.integers(0, 5000, 14)) + "."
    menu = lambda: " | ".join(f"$$$nav{i}***" for i in pick.integers(0, 5000, 9))

    def document(good):
        kinds = [prose if pick.random() < (0.9 if good else 0.25) else menu for _ in range(12)]
        return kinds, "\n".join(k() for k in kinds)

    made = [document(i % 2) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(300)], "doc_id bigint, quality int, toxic int")
    docs = docs_of(*[(i, text) for i, (_, text) in enumerate(made)])
    field = line_crf.train_field(docs, labels)
    right = total = 0
    for kinds, text in made:
        lines = line_crf.lines_of(*words.buffers(pa.array([text])))
        found = line_crf.viterbi(field, lines.codes, lines.doc)
        right += sum(f == (k is prose) for f, k in zip(found, kinds, strict=True))
        total += len(kinds)
    assert right > 0.98 * total
    shares = {r.doc_id: (r.content_share, r.kept) for r in line_crf.quality_report(docs, field).collect()}
    mixed = [d for d, (kinds, _) in enumerate(made) if 0 < sum(k is prose for k in kinds) < 12]
    assert sum(0 < shares[d][0] < 1 for d in mixed) > 0.95 * len(mixed) > 200
    assert all(kept == (share >= 0.5) for share, kept in shares.values())
