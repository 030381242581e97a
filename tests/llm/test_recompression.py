import hashlib
import random
import re
from collections import Counter

import pytest

from llm_docs import docs_of  # noqa: F401
from flowtide.llm import recompression


def brute(texts, window):
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts}
    seen = Counter(tuple(w[k : k + window]) for w in split.values() for k in range(len(w) - window + 1))
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("alphabet,window", [(2, 35), (3, 35), (50, 35), (4, 12)])
def test_equals_brute_force(spark, docs_of, alphabet, window):
    """Small alphabets make runs and periods of every kind; passages and copies are planted on top."""
    pick = random.Random(alphabet * window)
    word = lambda: f"w{pick.randrange(alphabet)}"
    passage = [word() for _ in range(60)]
    texts = []
    for i in range(40):
        body = [word() for _ in range(pick.randrange(0, 120))]
        if i % 3 == 0:
            at, low = pick.randrange(len(body) + 1), pick.randrange(0, 30)
            body[at:at] = passage[low : pick.randrange(low, 61)]
        texts.append((i, pick.choice([" ", "\n", "  "]).join(body)))
    texts += [(40, "w0 " * 34), (41, "w0 " * 35), (42, "w1 " * 36), (43, "a b " * 40), (44, texts[5][1]), (45, None), (46, "")]
    got = recompression.removal_report(docs_of(*texts), window).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute(texts, window)


def test_edge_cases(spark, docs_of):
    long = " ".join(f"x{i}" for i in range(40))
    docs = docs_of((1, long), (1, long), (None, "short\xa0text"), (2, " lone  words "))
    rows = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in recompression.removal_report(docs).collect())
    assert rows == [(-1, 1, 0), (1, 40, 40), (1, 40, 40), (2, 2, 0)]
    cut = recompression.without_repeats(docs)
    assert cut.columns == docs.columns
    assert sorted((r.text, r.n_chars) for r in cut.collect()) == [("", 0), ("", 0), (" lone  words ", 13), ("short\xa0text", 10)]
    assert recompression.removal_report(docs.limit(0)).count() == 0
    assert recompression.without_repeats(docs.limit(0)).count() == 0


def test_hot_passage(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(45))
    texts = [(i, f"own{i} {passage} end{i}" if i % 3 else f"alone{i}") for i in range(300)]
    got = {r.doc_id: r.n_removed for r in recompression.removal_report(docs_of(*texts)).collect()}
    assert all(got[i] == (45 if i % 3 else 0) for i in range(300))


def test_thue_morse_words_and_passages_are_told_apart(spark, docs_of):
    """Polynomials modulo a power of two cannot tell a Thue-Morse sequence from its mirror image."""
    bits = [0]
    for _ in range(10):
        bits += [1 - b for b in bits]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    tail = " ".join(f"t{i}" for i in range(34))
    texts = [(0, f"{one} {tail}"), (1, f"{two} {tail}")]
    texts += [(2 + flip, " ".join(f"w{b ^ flip}" for b in bits) + f" end{flip}") for flip in (0, 1)]
    got = {r.doc_id: tuple(r)[1:] for r in recompression.removal_report(docs_of(*texts)).collect()}
    assert got == brute(texts, 35)
    assert got[0][1] == got[1][1] == 0
