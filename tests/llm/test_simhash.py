import random
import re

import numpy as np
import pytest
import xxhash

from llm_docs import docs_of  # noqa: F401
from flowtide.llm import simhash
from flowtide.llm.components import components


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        parent[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, out.values()))


def test_fingerprints():
    for text in ("", "One", "one TWO", "A b c ÄÖ d\x85e f  g\n", "x y z x y z", "É é " * 9, None):
        assert simhash.fingerprint((text or "").encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("max_bits", [2, 3])
def test_links_give_the_groups_of_all_close_pairs(spark, max_bits):
    pick = np.random.default_rng(3)
    prints = set()
    for _ in range(150):
        base = int(pick.integers(0, 1 << 63)) * 2 + int(pick.integers(0, 2))
        prints.add(base)
        for _ in range(int(pick.integers(0, 5))):
            near = base
            for bit in pick.choice(64, int(pick.integers(1, 5)), replace=False):
                near ^= 1 << int(bit)
            prints.add(near)
    prints |= {0, 1, 3, 7, 15, (1 << 64) - 1}
    values = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fingerprint bigint"), max_bits).collect()
    close = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits
    assert all(close(r.u, r.v) for r in found)
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if close(a, b)]
    assert groups(values, pairs) == groups(values, [(r.u, r.v) for r in found])


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 300), (7, 3)]
    got = components(spark.createDataFrame(edges, "u bigint, v bigint"))
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert {r.node: r.root for r in got.collect()} == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_groups_and_the_one_that_stays(spark, docs_of):
    pick = random.Random(4)
    base = " ".join(f"w{pick.randrange(400)}" for _ in range(300))
    docs = docs_of((5, base), (3, base), (9, base + " tail"), (None, base), (7, ""), (6, None), (8, "other words here"), (8, "other words here"))
    rows = simhash.simhash_groups(docs).collect()
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert len(rows) == 8 and prints[7] == prints[6] == 0
    named = sorted((r.doc_id or -1, r.component_id) for r in rows)
    near = ((prints[9] ^ prints[3]) & (1 << 64) - 1).bit_count() <= 3
    assert named == [(-1, 3), (3, 3), (5, 3), (6, 6), (7, 6), (8, 8), (8, 8), (9, 3 if near else 9)]
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 8] + ([] if near else [9])
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_crowded_halves_are_dealt_out_by_variants(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_HALF", 30)
    pick = np.random.default_rng(8)
    values = sorted({int(5 << 32 | pick.integers(0, 1 << 12)) for _ in range(120)} | {int(v) for v in pick.integers(0, 1 << 62, 40)})
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fingerprint bigint"), 3).collect()
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 3]
    assert groups(values, pairs) == groups(values, [(r.u, r.v) for r in found])


def test_whole_query_equals_brute_force(spark):
    from flowtide.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    prints = {r.doc_id: slow_fingerprint(r.text) for r in docs}
    ids = sorted(prints)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 3]
    want = {n: (f"{prints[n]:016x}", g[0]) for g in groups(ids, pairs) for n in g}
    got = QUERIES["op9_simhash_groups"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(docs)
