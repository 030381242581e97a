import json
import math
import re
from collections import Counter
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from flowtide.operators import community, mapping, network, subgraph
from flowtide.operators.flows import value_flows
from flowtide.operators.lookup import category_map_frame
from flowtide.operators.similarity import similarity_matches

CHANGES = "id string, chain_name string, token_name string, qty double, usd double, qty_change double, usd_change double"


def changes(spark, *values):
    full = [(i, "E", t, 1.0, float(u), 1.0, None if c is None else float(c)) for i, t, u, c in values]
    return spark.createDataFrame(full, CHANGES)


def owners(spark, **of):
    return spark.createDataFrame(list(of.items()), "token_name string, mapped_id string")


@pytest.fixture(scope="module")
def flows(spark):
    data = changes(
        spark, ("1", "A", 100, -40), ("2", "B", 50, 10), ("2", "A", 20, 5), ("1", "Z", 7, -3), ("3", "A", 9, 60), ("2", "C", 4, 25)
    )
    return value_flows(data, owners(spark, A="2", B="1", C="3"))


def test_flow_directions(flows):
    expected = [("1", "2", 40), ("1", "2", 10), ("2", "2", 5), ("1", None, 3), ("2", "3", 60), ("3", "2", 25)]
    assert Counter(rows(flows, "from_node", "to_node", "usd_flow")) == Counter(expected)


def test_nodes(flows):
    assert rows(network.node_sizes(flows)) == sorted([("1", 107.0), ("2", 74.0), ("3", 9.0), (None, 0.0)], key=repr)
    assert rows(network.node_composition(flows)) == [
        ("1", "A", 100.0), ("1", "Z", 7.0), ("2", "A", 20.0), ("2", "B", 50.0), ("2", "C", 4.0), ("3", "A", 9.0),
    ]
    assert {r[0] for r in network.node_ids(flows).collect()} == {"1", "2", "3", None}


def test_links(flows):
    expected = [("1", "2", 50.0), ("1", None, 3.0), ("2", "2", 5.0), ("2", "3", 35.0)]
    assert rows(network.links(flows)) == sorted(expected, key=repr)
    carried = [("1", "2", "A", 40.0), ("1", "2", "B", 10.0), ("2", "2", "A", 5.0), ("1", None, "Z", 3.0)]
    carried += [("2", "3", "A", 60.0), ("2", "3", "C", -25.0)]
    assert rows(network.link_composition(flows)) == sorted(carried, key=repr)


def test_document(flows):
    parts = {}
    for part, text in network.network_document(flows, nested=True).collect():
        parts.setdefault(part, []).append(json.loads(text))
    assert {"id": "2", "size": 74.0, "composition": {"A": 20.0, "B": 50.0, "C": 4.0}} in parts["nodes"]
    assert {"id": None, "size": 0.0, "composition": {}} in parts["nodes"]
    assert {"source": "2", "target": "3", "size": 35.0, "composition": {"A": 60.0, "C": -25.0}} in parts["links"]


def test_document_in_chunks(flows):
    parts = {}
    for part, text in network.network_document(flows, tokens=2).collect():
        parts.setdefault(part, []).append(json.loads(text))
    assert {"id": "2", "size": 74.0} in parts["nodes"] and {"id": None, "size": 0.0} in parts["nodes"]
    assert {"source": "2", "target": "3", "size": 35.0} in parts["links"]
    mine = [t for t in parts["node_tokens"] if t["id"] == "2"]
    assert len(mine) >= 2 and {k: v for t in mine for k, v in t["composition"].items()} == {"A": 20.0, "B": 50.0, "C": 4.0}
    assert all(0 < len(t["composition"]) <= 2 for name in ("node_tokens", "link_tokens") for t in parts[name])


def test_a_node_with_most_tokens_is_never_one_cell(spark):
    hot = [("1", f"T{i}", 10, 1) for i in range(5000)]
    flows = value_flows(changes(spark, *hot, ("2", "T1", 5, 1)), owners(spark, T1="2"))
    lines = network.network_document(flows, tokens=100)
    sizes = lines.where("part = 'node_tokens'").select(F.size(F.from_json(F.get_json_object("json", "$.composition"), "map<string,double>")).alias("n"))
    found = sizes.agg(F.max("n"), F.sum("n"), F.count("*")).first()
    assert found[0] <= 100 and found[1] == 5001 and found[2] >= 50


def test_unknown_change_flows_in_without_amounts(spark):
    flows = value_flows(changes(spark, ("1", "A", 5, None)), owners(spark, A="2"))
    row = flows.first()
    assert (row.from_node, row.to_node, row.usd_to, row.usd_from, row.usd_flow) == ("2", "1", None, None, None)
    assert rows(network.node_sizes(flows)) == [("1", 0.0), ("2", 0.0)]
    assert rows(network.links(flows), "size") == [(0.0,)]


def test_copies_weigh_like_repeated_rows(spark):
    data = changes(spark, ("1", "A", 100, -40), ("2", "B", 50, 10))
    table = owners(spark, A="2", B="1")
    repeated = value_flows(data.unionByName(data).unionByName(data), table)
    folded = value_flows(data.selectExpr("*", "3L copies"), table)
    for operator in (network.node_sizes, network.node_composition, network.links, network.link_composition):
        assert rows(operator(folded)) == rows(operator(repeated))


def test_one_period_equals_the_plain_network(flows):
    dated = flows.selectExpr("timestamp_ntz'2024-01-01' period", "*")
    for operator in (network.node_sizes, network.links, network.link_composition):
        assert rows(operator(dated).drop("period")) == rows(operator(flows))


def test_invariants_and_antisymmetry(spark):
    data = spark.range(3_000).selectExpr(
        "cast(id % 17 as string) id", "'E' chain_name", "concat('T', cast(id % 23 as string)) token_name",
        "1d qty", "cast(id % 29 as double) usd", "0d qty_change", "cast((id * 7919) % 101 - 50 as double) usd_change",
    )
    table = owners(spark, **{f"T{i}": str(i % 11) for i in range(20)})
    flows = value_flows(data, table)
    links = {(r.source, r.target): r["size"] for r in network.links(flows).collect()}
    assert all(v >= 0 for v in links.values())
    assert not any((t, s) in links for s, t in links if s != t)
    carried = Counter()
    for r in network.link_composition(flows).collect():
        carried[(r.source, r.target)] += r.amount
    assert {k: pytest.approx(v) for k, v in carried.items()} == links
    swapped = flows.selectExpr("to_node from_node", "from_node to_node", "token_name", "usd_flow")
    turned = {(r.source, r.target): r["size"] for r in network.links(swapped).collect()}
    assert {(t, s): v for (s, t), v in links.items() if v and s != t} == {k: v for k, v in turned.items() if v and k[0] != k[1]}


def test_reverse_map_lowest_tvl_wins(spark):
    ranked = spark.createDataFrame(
        [("1", 100.0, "X", "-"), ("2", 50.0, "X", None), ("3", 10.0, "-", "Y"), ("4", 1.0, "None", "nan")],
        "id string, total_tvls double, symbol string, assetToken string",
    )
    assert rows(mapping.reverse_map(ranked), "token", "id") == [("X", "2"), ("Y", "3")]
    assert ("None", "4") in rows(mapping.reverse_map(ranked, strict_text=True), "token", "id")


def test_token_classes_and_default_ids(spark):
    names = ["X", "UNI-LP", "UNKNOWN-LP", "UNKNOWN (0x)", "a-b", "lp", None]
    facts = spark.createDataFrame([(n,) for n in names], "token_name string")
    classes = mapping.token_classes(facts, spark.createDataFrame([("X", "2")], "token string, id string"))
    none = spark.createDataFrame([], "token_name string, primary_id string")
    assert dict(rows(mapping.rule_token_map(classes, none), "token_name", "class")) == {
        "X": "MAP", "UNI-LP": "LP", "UNKNOWN-LP": "LP", "UNKNOWN (0x)": "UNKNOWN", "a-b": "OTHER", "lp": "PRIMARY",
    }
    assert dict(rows(mapping.rule_token_map(classes, none), "token_name", "mapped_id")) == {
        "X": "2", "UNI-LP": "LP", "UNKNOWN-LP": "LP", "UNKNOWN (0x)": "UNKNOWN", "a-b": "OTHER", "lp": "lp",
    }


def test_primary_override_takes_the_largest_protocol_of_the_name(spark):
    ranked = spark.createDataFrame([("1", "Aave", 5.0), ("2", "Aave", 9.0)], "id string, name string, total_tvls double")
    manual = spark.createDataFrame([("AAVE", "Aave"), ("UNI", "Uniswap")], "token_name string, protocol_name string")
    assert rows(mapping.primary_owners(manual, ranked)) == [("AAVE", "2")]


def test_total_tvls_of_dict_texts(spark):
    texts = ["{'Ethereum': 1.5, 'Polygon': 2}", "", None, "None"]
    given = spark.createDataFrame([(t,) for t in texts], "currentChainTvls string")
    assert [r.total_tvls for r in mapping.with_total_tvls(given).collect()] == [3.5, 0.0, 0.0, 0.0]


def test_id_info_turns_missing_categories_into_unknown(spark):
    given = spark.createDataFrame([("1", "a", None), ("2", "b", "?"), ("3", "c", "Dexes")], "id string, name string, category string")
    info = mapping.id_info(given, category_map_frame(spark, {"Trading": ["Dexes"]}))
    assert rows(info, "id", "category") == [("1", "Unknown"), ("2", "Unknown"), ("3", "Trading")]


def _brute_force(tokens, protocols, threshold):
    """Plain-Python TF-IDF cosine of every pair."""
    docs = [re.findall(r"[^\W]{2,}", t.lower()) for t in [*tokens, *[p[2] for p in protocols]]]
    df = Counter(term for d in docs for term in set(d))

    def vector(terms):
        raw = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in Counter(terms).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {t: v / norm for t, v in raw.items()}

    vectors = [vector(d) for d in docs]
    best = {}
    for token, left in zip(tokens, vectors):
        scored = [
            (-round(sum(w * right.get(t, 0) for t, w in left.items()), 12), -p[3], p[0])
            for p, right in zip(protocols, vectors[len(tokens):])
        ]
        score, _, id = min(scored)
        if -score >= threshold:
            best[token] = (id, pytest.approx(-score))
    return best


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.7])
def test_similarity_equals_brute_force(spark, threshold):
    words = ["aave", "uni", "swap", "lending", "the", "pool", "café", "x", "dao", "usd"]
    tokens = [f"{words[i % 10]} {words[(i * 3) % 10]}-{words[(i // 4) % 7]} the" for i in range(40)]
    tokens = sorted(set(tokens)) + ["x", "aave"]
    protocols = [
        (str(i), f"n{i}", " ".join(words[(i * k) % 10] for k in range(1, 2 + i % 6)) + " the the", float(i % 3)) for i in range(30)
    ]
    left = spark.createDataFrame([(t,) for t in tokens], "token_name string")
    right = spark.createDataFrame(protocols, "id string, name string, text string, total_tvls double")
    got = {r.token_name: (r.id, r.score) for r in similarity_matches(left, right, threshold, ["text"]).collect()}
    assert got == _brute_force(tokens, protocols, threshold)


def test_similarity_of_the_worked_example(spark):
    left = spark.createDataFrame([("aave",)], "token_name string")
    right = spark.createDataFrame(
        [("1", "a", "aave lending", 1.0), ("2", "u", "uni swap", 9.0)], "id string, name string, text string, total_tvls double"
    )
    row = similarity_matches(left, right, 0.5, ["text"]).first()
    assert (row.id, row.score) == ("1", pytest.approx(0.605349, abs=1e-6))
    with pytest.raises(ValueError):
        similarity_matches(left, right, 0.0)


def _shuffled(plan) -> int:
    """Records that the exchanges of an executed plan have written."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _shuffled(plan.executedPlan())
    if name.endswith("QueryStage"):
        return _shuffled(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return own + sum(_shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


def test_similarity_does_not_shuffle_the_terms_of_texts(spark, monkeypatch):
    ran, kind = [], type(spark.range(0))
    checkpoint = kind.checkpoint

    def noted(self, *args, **named):
        ran.append(self)
        return checkpoint(self, *args, **named)

    monkeypatch.setattr(kind, "checkpoint", noted)
    texts = [(str(i), "n", " ".join(f"w{(i * 37 + k * k) % 600}" for k in range(60)) + " the aave", 1.0) for i in range(400)]
    right = spark.createDataFrame(texts + [("400", "n", "aave lending", 1.0)], "id string, name string, text string, total_tvls double").repartition(4)
    found = similarity_matches(spark.createDataFrame([("aave lending",)], "token_name string"), right, 0.5, ["text"])
    assert [(r.id, round(r.score, 6)) for r in found.collect()] == [("400", 1.0)]
    pairs = sum(len(set(t[2].split())) for t in texts)
    assert 0 < sum(_shuffled(df._jdf.queryExecution().executedPlan()) for df in [*ran, found]) < pairs / 2


def test_similarity_of_repeated_and_missing_ids(spark):
    """Texts of one id are one text; all without id count once for the frequencies and match nothing."""
    texts = [("1", "n", "aave lending", 1.0), ("1", "n", "pool pool", 2.0), (None, "n", "aave uni", 3.0), (None, "n", "uni uni dao", 4.0), ("2", "m", None, 5.0)]
    right = spark.createDataFrame(texts, "id string, name string, text string, total_tvls double")
    found = similarity_matches(spark.createDataFrame([("aave",), ("uni dao",)], "token_name string"), right, 0.2, ["text"]).collect()
    idf = {t: math.log(8 / (1 + df)) + 1 for t, df in {"aave": 3, "lending": 1, "pool": 1}.items()}
    norm = math.sqrt(idf["aave"] ** 2 + idf["lending"] ** 2 + 4 * idf["pool"] ** 2)
    assert [(r.token_name, r.id, r.name) for r in found] == [("aave", "1", "n")]
    assert found[0].score == pytest.approx(idf["aave"] / norm)


def test_top_network_scales_sizes(spark):
    nodes = spark.createDataFrame([("a", 0.0), ("b", 50.0), ("c", 100.0), ("d", -1.0)], "id string, size double")
    links = spark.createDataFrame(
        [("a", "b", 2.0), ("b", "c", 4.0), ("a", "d", 9.0)], "source string, target string, size double"
    )
    names = spark.createDataFrame([("b", "Bee")], "id string, name string")
    top = subgraph.top_network(nodes, links, names, top_x=3)
    assert rows(top.nodes, "id", "visual_size") == [("Bee", 20.0), ("a", 10.0), ("c", 30.0)]
    assert rows(top.edges, "source", "target", "visual_size") == [("Bee", "c", 5.0), ("a", "Bee", 1.0)]
    equal = subgraph.top_network(nodes.selectExpr("id", "7d size"), links, top_x=3)
    assert {r.visual_size for r in equal.nodes.collect()} == {10.0}


def test_label_propagation_finds_two_cliques(spark):
    def clique(names):
        return [(a, b) for a in names for b in names if a < b]

    pairs = clique("abcd") + clique("wxyz") + [("d", "w")]
    time = datetime(2024, 1, 1)
    edges = spark.createDataFrame(
        [(time, s, t, 10.0 if (s, t) != ("d", "w") else 0.1) for s, t in pairs] + [(datetime(2024, 2, 1), "q", "q", 1.0)],
        "time timestamp, source string, target string, size double",
    )
    weights = subgraph.edge_weights(edges)
    labels = community.label_propagation(weights)
    groups = {}
    for r in labels.collect():
        groups.setdefault((r.time, r.community), set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list("abcd"), ["q"], list("wxyz")]
    quality = {r.time: r for r in community.partition_quality(weights, labels).collect()}[time]
    assert quality.communities == 2 and quality.coverage > 0.99 and 0.4 < quality.modularity < 0.5
    sizes = spark.createDataFrame([(time, "a", 5.0), (time, "a", 7.0)], "time timestamp, id string, size double")
    members = {r.node: r["size"] for r in community.community_members(labels, sizes).collect()}
    assert members["a"] == 7.0 and members["b"] is None


def test_directed_communities_find_what_propagation_misses(spark):
    """Directed rings whose first members are joined by a heavy one-way edge; quality is never below label propagation."""
    rows_ = []
    for g in range(5):
        for i in range(8):
            rows_ += [("t", f"g{g}n{i}", f"g{g}n{(i + d) % 8}", 1.0) for d in (1, 2)]
        rows_.append(("t", f"g{g}n0", f"g{(g + 1) % 5}n0", 2.0))
    rows_ += [("u", "a", "b", 1.0), ("u", "b", "a", 1.0), ("u", "c", "a", 0.0), ("v", "x", "x", 1.0)]
    weights = spark.createDataFrame(rows_, "time string, source string, target string, weight double")
    found = community.directed_communities(weights).checkpoint()
    assert {r.node: r.community for r in found.where("time = 't'").collect()} == {f"g{g}n{i}": f"g{g}n0" for g in range(5) for i in range(8)}
    spread = community.label_propagation(weights).withColumnRenamed("community", "label")
    assert spread.where("time = 't'").select("label").distinct().count() != 5
    flows = weights.withColumnRenamed("weight", "flow")
    a, b = (
        {r.time: r.modularity for r in community.directed_modularity(flows, t).collect()}
        for t in (found.withColumnRenamed("community", "label"), spread)
    )
    assert a["t"] > b["t"] and all(a[k] >= b[k] - 1e-9 for k in b)
    assert found.where("time = 'u'").count() == 3 and found.where("time = 'v'").count() == 1


def test_a_round_of_directed_moves_is_few_shuffles(spark):
    """Moves and quality of a labelling come from one tally; the quality is the directed modularity."""
    arcs = [(t, f"n{i}", f"n{(i * 7 + d) % 11}", float(1 + (i * d) % 3)) for t in "uv" for i in range(11) for d in (0, 1, 4)] + [("w", "x", "x", 1.0)]
    flows = spark.createDataFrame(arcs, "time string, source string, target string, flow double").groupBy("time", "source", "target").agg(F.sum("flow").alias("flow"))
    nodes, links = community._level(flows, flows.groupBy("time").agg(F.sum("flow").alias("total")))
    labels = nodes.withColumn("label", F.when(F.col("time") == "u", F.col("node")).otherwise(F.concat(F.lit("c"), F.substring("node", 2, 1))))
    weighed = community._weighed(links, labels)
    plan = weighed._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 6
    got = {r.time: r.q for r in community._quality(weighed, "q").collect()}
    want = {r.time: r.modularity for r in community.directed_modularity(flows, labels.select("time", "node", "label")).collect()}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-12 for t in want)


def test_visit_rates_are_stationary(spark):
    edges = [("t", "a", "b", 3.0), ("t", "a", "c", 1.0), ("t", "b", "a", 1.0), ("t", "c", "d", 2.0)]
    weights = spark.createDataFrame(edges, "time string, source string, target string, weight double")
    got = {r.node: r.rate for r in community.visit_rates(weights, tolerance=1e-9).collect()}
    assert abs(sum(got.values()) - 1) < 1e-9
    rest = 0.85 * got["d"] / 4 + 0.15 / 4
    want = {"a": 0.85 * got["b"] + rest, "b": 0.85 * 0.75 * got["a"] + rest, "c": 0.85 * 0.25 * got["a"] + rest, "d": 0.85 * got["c"] + rest}
    assert all(abs(want[n] - got[n]) < 1e-6 for n in want)
