import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_docs import docs_of  # noqa: F401
from flowtide.llm import merkle_audit, norm_topk, poisson_mix, preferences


def inverse(rate, u):
    k, p = 0, math.exp(-rate)
    f = p
    while f <= u:
        k += 1
        p *= rate / k
        f += p
    return k


def test_poisson_inverts_the_distribution(spark):
    rows = [(rate, (i + 0.5) / 200) for rate in (0.01, 0.7, 3.0, 31.5) for i in range(200)]
    df = spark.createDataFrame(rows, "rate double, u double").select("rate", "u", poisson_mix.poisson(F.col("rate"), F.col("u")).alias("k"))
    assert all(r.k == inverse(r.rate, r.u) for r in df.collect())


def test_mix_reaches_the_weights_and_repeats_itself(spark, docs_of):
    rows = [(i, f"t{i}", "en", "big" if i % 10 else "small") for i in range(3000)]
    docs = docs_of(*rows)
    weight = F.when(F.col("source") == "small", 3.0).otherwise(1.0)
    mixed = poisson_mix.mix(docs, weight=weight, total=4000)
    got = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    # expected 3000 and 1000, with Poisson noise
    assert abs(got["small"] - 3000) < 6 * math.sqrt(3000) and abs(got["big"] - 1000) < 6 * math.sqrt(1000)
    again = {(r.doc_id, r._copy, r._order) for r in poisson_mix.mix(docs, weight=weight, total=4000).collect()}
    assert again == {(r.doc_id, r._copy, r._order) for r in mixed.repartition(7).collect()}
    assert mixed.columns == [*docs.columns, "_copy", "_order", "_rate"]


def test_mix_of_null_sources_repeats_large_rates_and_nothing(spark, docs_of):
    docs = docs_of((1, "a", "en", None), (2, None, "en", "s"), (2, None, "en", "s"), (None, "x", "en", "s"))
    mixed = poisson_mix.mix(docs, total=400).collect()
    assert {r.source for r in mixed} == {None, "s"} and abs(len(mixed) - 400) < 6 * 20
    assert len({(r.doc_id, r._copy) for r in mixed if r.doc_id == 1}) == sum(r.doc_id == 1 for r in mixed)
    assert sum(r.doc_id == 2 for r in mixed) % 2 == 0
    assert poisson_mix.mix(docs.limit(0)).count() == 0


def slow_top(vectors, asked, k):
    rows = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            rows.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in v))
    out = []
    for q in sorted({i for i in asked if i in rows}):
        best = {}
        for c, vs in rows.items():
            scores = [sum(a * b for a, b in zip(x, y, strict=True)) for x in rows[q] for y in vs if len(x) == len(y)]
            if c != q and scores:
                best[c] = max(scores)
        top = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]
        out += [(q, r + 1, c, s) for r, (c, s) in enumerate(top)]
    return out


@pytest.mark.parametrize("shape", ["spread", "equal lengths", "clusters", "negative"])
def test_top_k_equals_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(norm_topk, "BLOCK", 64)
    monkeypatch.setattr(norm_topk, "QUERY_BLOCK", 7)
    pick = np.random.default_rng(len(shape))
    v = pick.normal(size=(400, 8))
    if shape == "spread":
        v *= pick.lognormal(0, 1.5, (400, 1))
    elif shape == "equal lengths":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif shape == "clusters":
        v = np.repeat(pick.normal(size=(8, 8)), 50, axis=0) + 0.05 * v
    else:
        v = -np.abs(v) * np.where(np.arange(400)[:, None] % 50 == 0, -1, 1)
    v[30:60] = v[30]
    vectors = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    vectors += [(500, None), (550, [1.0, None] + [0.0] * 6), (600, [float("nan")] * 8), (650, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    vectors += [(700, [0.0] * 8), (750, [1.0, 2.0]), (751, [2.0, 1.0]), (800, []), vectors[3]]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash"))
    got = norm_topk.top_k(df, df.where("vec_id % 50 = 0"), k=5).collect()
    assert sorted(map(tuple, got)) == slow_top(vectors, [i for i, _ in vectors if i is not None and i % 50 == 0], 5)


def test_top_k_with_query_blocks_that_stay_empty(spark, monkeypatch):
    monkeypatch.setattr(norm_topk, "QUERY_BLOCK", 1)
    vectors = [(i, [float(i % 7), float(i % 5)]) for i in range(60)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    got = norm_topk.top_k(df, df.where("vec_id % 10 = 0"), k=3).collect()
    assert sorted(map(tuple, got)) == slow_top(vectors, range(0, 60, 10), 3)


def test_top_k_counts_an_id_with_many_vectors_once(spark):
    pick = np.random.default_rng(7)
    vectors = [(i, pick.normal(size=4).tolist()) for i in range(1, 60)]
    # close but unequal, and the longest of all; the queries have several vectors too
    vectors += [(7, [9.0 + j / 16, 9.0, 9.0, 9.0]) for j in range(40)] + [(0, [1.0, 1.0, 1.0, j / 16]) for j in range(6)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = norm_topk.top_k(df, df.where("vec_id % 10 = 0"), k=5).collect()
    assert sorted(map(tuple, got)) == slow_top(vectors, range(0, 60, 10), 5)


def test_top_k_of_large_components_is_exact_or_fails(spark):
    vectors = [(i, [float(300_000 + i), float(i % 3)]) for i in range(20)] + [(50, [2.0**40, 1.0]), (51, [2.0**40, 2.0]), (100, [1.0, 3.0])]
    df = spark.createDataFrame([v for v in vectors if v[0] < 50 or v[0] == 100], "vec_id bigint, embedding array<double>")
    got = norm_topk.top_k(df, df.where("vec_id % 50 = 0"), k=5).collect()
    assert sorted(map(tuple, got)) == slow_top([v for v in vectors if v[0] < 50 or v[0] == 100], [0, 100], 5)
    rows = np.array([[2.0**61, -(2.0**61) + 2**9, 3.0], [2.0**40, 1.0, 0.0]])
    assert norm_topk._products(rows, np.array([4.0, 4.0, 1.0])).tolist() == [2**11 + 3, 2**42 + 4]
    with pytest.raises(OverflowError):
        norm_topk._products(rows, np.array([2.0**30, 0.0, 0.0]))
    wide = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="outside the range of long"):
        norm_topk.top_k(wide, wide.where("vec_id % 50 = 0"), k=5).collect()


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert norm_topk.top_k(empty, empty).count() == 0


def test_pruning_keeps_every_row_that_reaches_the_bound():
    pick = np.random.default_rng(5)
    rows = pick.integers(-300, 300, (500, 6)).astype(float)
    bucket = norm_topk.Bucket(np.arange(500), rows, np.linalg.norm(rows, axis=1))
    for query in pick.integers(-300, 300, (40, 6)).astype(float):
        scores = bucket.rows @ query
        for bound in np.sort(scores)[[-1, -5, -50, -200]]:
            kept = bucket.candidates(query, float(np.linalg.norm(query)), float(bound))
            assert set(np.flatnonzero(scores >= bound)) <= set(kept.tolist())


def records(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "file string, offset bigint, payload string, hash string")


def test_merkle_audit_finds_what_differs(spark):
    pick = np.random.default_rng(1)
    rows = [(f"f{f}", int(o), f"{f}-{o}" * 3) for f in range(3) for o in np.cumsum(pick.integers(1, 40, 300))]
    damaged = [(f, o, "!" if i == 70 else p) for i, (f, o, p) in enumerate(rows) if i != 400]
    damaged += [rows[10], ("f9", 5, "new"), (None, 5, "no file"), ("f1", None, "no place")]
    found = merkle_audit.audit(records(spark, *rows), records(spark, *damaged), leaf=64, fanout=4).collect()
    want = {(*rows[70][:2], "changed"), (*rows[400][:2], "missing"), (*rows[10][:2], "repeated"), ("f9", 5, "extra")}
    assert {(r.file, r.offset, r.kind) for r in found} == want and len(found) == 4
    assert merkle_audit.audit(records(spark, *rows), records(spark, *rows[::-1]), leaf=64, fanout=4).count() == 0


def test_merkle_audit_of_odd_tables(spark):
    none = records(spark).limit(0)
    assert merkle_audit.audit(none, none).count() == 0
    one = records(spark, ("a", 0, None), ("a", 0, "b"), ("a", 0, "c"))
    assert {r.kind for r in merkle_audit.audit(one, none).collect()} == {"missing"} and merkle_audit.audit(one, none).count() == 3
    other = records(spark, ("a", 0, ""), ("a", 0, "b"), ("a", 0, "d"))
    assert sorted(r.kind for r in merkle_audit.audit(one, other).collect()) == ["changed", "changed"]


def test_tree_descends_only_where_nodes_differ(spark):
    rows = [("f", i * 10, f"r{i}") for i in range(2000)]
    levels = merkle_audit.tree(merkle_audit.leaves(records(spark, *rows)), leaf=100, fanout=4)
    assert [level.count() for level in levels] == [200, 50, 13, 4, 1]


TURNS = "pair_id bigint, turn bigint, role string, text string, prompt string"


def test_preferences(spark):
    chosen = [(1, 0, "user", "hi", ""), (1, 1, "assistant", "yes", ""), (1, 2, "user", "more", ""), (1, 3, "assistant", "ok", "")]
    rejected = [*chosen[:3], chosen[0], (1, 3, "assistant", "no way", ""), (1, 4, "user", "bye", "")]
    chosen += [(2, 0, "user", "a<|im_end|>", ""), (3, 0, "user", "same", ""), (None, 0, "user", "x", ""), (4, None, None, None, ""), (5, 0, "user", "p", "")]
    rejected += [(3, 0, "user", "same", ""), (4, 0, "assistant", "é", ""), (5, 0, "user", "p", ""), (5, 1, "assistant", "q", "")]
    made = preferences.format_preferences(spark.createDataFrame(chosen, TURNS), spark.createDataFrame(rejected, TURNS))
    got = {r.pair_id: r for r in made.collect()}
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    one = got[1]
    assert one.prompt_turns == 3 and one.prompt == turn("user", "hi") + turn("assistant", "yes") + turn("user", "more")
    assert one.chosen == turn("assistant", "ok") and one.rejected == turn("assistant", "no way") + turn("user", "bye")
    cut = lambda text, spans: [text[s.start : s.end] for s in spans]
    assert cut(one.chosen, one.chosen_spans) == ["ok<|im_end|>"] and cut(one.rejected, one.rejected_spans) == ["no way<|im_end|>"]
    assert (got[2].prompt, got[2].chosen, got[2].rejected) == ("", turn("user", "a< |im_end|>"), "")
    assert (got[3].prompt, got[3].chosen, got[3].rejected) == (turn("user", "same"), "", "")
    assert (got[4].prompt_turns, got[4].chosen, got[4].rejected) == (0, turn("", ""), turn("assistant", "é"))
    assert (got[5].prompt_turns, got[5].chosen, got[5].rejected) == (1, "", turn("assistant", "q"))
    assert set(got) == {1, 2, 3, 4, 5}
    empty = spark.createDataFrame([], TURNS)
    assert preferences.format_preferences(empty, empty).count() == 0


def test_preference_query_runs_no_python(spark):
    from flowtide.llm.queries import QUERIES

    plan = QUERIES["op1_preference_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
