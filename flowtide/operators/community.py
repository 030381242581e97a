"""Communities for all time slices in one job: by weighted label propagation, or by the direction of the edges.

Distributed stand-ins for map-equation search: labels differ from that method's, so
``partition_quality`` and ``directed_modularity`` report how good a result is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.plans.skew import skewed_join
from flowtide.session import ensure_checkpoints


def _arcs(weights: DataFrame) -> DataFrame:
    """Both directions of every edge, parallel ones added up, without self-loops."""
    ends = F.array(
        F.struct(F.col("source").alias("node"), F.col("target").alias("other")),
        F.struct(F.col("target").alias("node"), F.col("source").alias("other")),
    )
    return (
        weights.where(F.col("source") != F.col("target"))
        .select("time", F.explode(ends).alias("end"), "weight")
        .groupBy("time", "end.node", "end.other")
        .agg(F.sum("weight").alias("weight"))
    )


def label_propagation(weights: DataFrame, max_rounds: int = 500) -> DataFrame:
    """``time, node, community`` of the weighted edges ``time, source, target, weight``.

    A node prefers the label with the largest edge weight among its neighbours; ties keep the own label,
    then go to the smallest. In every round a hashed half of the nodes takes its preference, since two groups
    that all move at once can swap labels forever. Rounds end when every node has what it prefers; labels that still move
    after ``max_rounds`` are an error, never a result. Each round
    is cut off by a checkpoint in the cluster's shared folder, so a lost executor never replays
    earlier rounds. A hub's votes are combined map-side.
    """
    ensure_checkpoints(weights.sparkSession)
    arcs = _arcs(weights).checkpoint()
    nodes = weights.select("time", F.explode(F.array("source", "target")).alias("node"))
    labels = nodes.dropna().distinct().select("time", "node", F.col("node").alias("label")).checkpoint()
    for turn in range(max_rounds):
        known = labels.select("time", F.col("node").alias("other"), "label")
        heard = skewed_join(arcs, known, ["time", "other"], "inner").select(
            "time", "node", "label", "weight", F.lit(False).alias("own")
        )
        own = labels.select("time", "node", "label", F.lit(0.0).alias("weight"), F.lit(True).alias("own"))
        tally = (
            heard.unionByName(own)
            .groupBy("time", "node", "label")
            # rounding makes votes equal that differ only by the order of their summation
            .agg(F.round(F.sum("weight"), 9).alias("votes"), F.max("own").alias("own"))
        )
        preference = F.min_by(F.struct("label", "own"), F.struct(-F.col("votes"), ~F.col("own"), "label"))
        choices = tally.groupBy("time", "node").agg(
            F.max(F.when(F.col("own"), F.col("label"))).alias("current"), preference.alias("best")
        )
        moves = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0
        labels = choices.select(
            "time",
            "node",
            F.when(moves, F.col("best.label")).otherwise(F.col("current")).alias("label"),
            (~F.col("best.own")).alias("unsettled"),
        ).checkpoint()
        if labels.where("unsettled").isEmpty():
            break
    else:
        raise RuntimeError(f"labels still move after {max_rounds} rounds")
    return labels.select("time", "node", F.col("label").alias("community"))


def community_members(labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Attach the node sizes of the same slice; of several rows for one node the largest counts."""
    sizes = nodes.groupBy("time", F.col("id").alias("node")).agg(F.max("size").alias("size"))
    return labels.join(sizes, ["time", "node"], "left").select("time", "community", "node", "size")


def partition_quality(weights: DataFrame, labels: DataFrame) -> DataFrame:
    """Coverage and (undirected) modularity of a labelling, per time slice."""
    of_source = labels.select("time", F.col("node").alias("source"), F.col("community").alias("_from"))
    of_target = labels.select("time", F.col("node").alias("target"), F.col("community").alias("_to"))
    labelled = skewed_join(
        skewed_join(weights, of_source, ["time", "source"], "inner"),
        of_target,
        ["time", "target"],
        "inner",
    )
    inside = F.when(F.col("_from") == F.col("_to"), F.col("weight")).otherwise(F.lit(0.0))
    totals = labelled.groupBy("time").agg(F.sum("weight").alias("total"), F.sum(inside).alias("inside"))
    ends = F.explode(F.array("_from", "_to")).alias("community")
    shares = (
        labelled.select("time", "weight", ends)
        .groupBy("time", "community")
        .agg(F.sum("weight").alias("strength"))
        .join(totals, "time")
        .groupBy("time")
        .agg(
            F.sum(F.pow(F.try_divide(F.col("strength"), 2 * F.col("total")), F.lit(2.0))).alias("expected"),
            F.count("*").alias("communities"),
        )
    )
    coverage = F.try_divide("inside", "total")
    return totals.join(shares, "time").select(
        "time", "communities", coverage.alias("coverage"), (coverage - F.col("expected")).alias("modularity")
    )


def visit_rates(weights: DataFrame, teleport: float = 0.15, tolerance: float = 1e-3, max_rounds: int = 200) -> DataFrame:
    """``time, node, rate``: how often a walk along the directed edges visits each node, where it jumps anywhere with ``teleport``.

    The rates of a slice add up to one. Steps are taken until those of no slice move by more than ``tolerance`` in
    all; five are one job, cut off by a checkpoint.
    """
    ensure_checkpoints(weights.sparkSession)
    arcs = weights.where("weight > 0 and source is not null and target is not null").groupBy("time", "source", "target").agg(F.sum("weight").alias("weight"))
    leaving = arcs.groupBy("time", "source").agg(F.sum("weight").alias("out"))
    steps = skewed_join(arcs, leaving, ["time", "source"], "inner").select("time", F.col("source").alias("node"), "target", (F.col("weight") / F.col("out")).alias("share"))
    steps = steps.checkpoint()
    nodes = weights.select("time", F.explode(F.array("source", "target")).alias("node")).dropna().distinct()
    ends = steps.select("time", "node").distinct().withColumn("leads", F.lit(True))
    nodes = nodes.join(ends, ["time", "node"], "left").select("time", "node", F.coalesce("leads", F.lit(False)).alias("leads"))
    counts = nodes.groupBy("time").agg(F.count("*").alias("n"))
    nodes = nodes.join(counts, "time").checkpoint()
    rates = nodes.withColumn("rate", 1 / F.col("n")).checkpoint()
    for _ in range(max_rounds // 5):
        before = rates
        for _ in range(5):
            stuck = rates.groupBy("time").agg(F.sum(F.when(~F.col("leads"), F.col("rate")).otherwise(0.0)).alias("stuck"))
            moved = skewed_join(steps, rates.select("time", "node", "rate"), ["time", "node"], "inner")
            arrived = moved.groupBy("time", F.col("target").alias("node")).agg(F.sum(F.col("rate") * F.col("share")).alias("arrived"))
            known = nodes.join(arrived, ["time", "node"], "left").join(stuck, "time")
            walked = F.coalesce("arrived", F.lit(0.0)) + F.col("stuck") / F.col("n")
            rates = known.select("time", "node", "leads", "n", (walked * (1 - teleport) + teleport / F.col("n")).alias("rate"))
        rates = rates.checkpoint()
        old = before.select("time", "node", F.col("rate").alias("_old"))
        moves = rates.join(old, ["time", "node"]).groupBy("time").agg(F.sum(F.abs(F.col("rate") - F.col("_old"))).alias("move"))
        if moves.where(F.col("move") > tolerance).isEmpty():
            break
    else:
        raise RuntimeError(f"visit rates still move after {max_rounds} rounds")
    return rates.select("time", "node", "rate")


def _strengths(arcs: DataFrame, labels: DataFrame) -> DataFrame:
    """``time, label, out, into``: the flow that leaves and enters each community, inner flow included."""
    ends = F.explode(F.array(F.struct(F.col("source").alias("node"), F.col("flow").alias("out"), F.lit(0.0).alias("into")),
                             F.struct(F.col("target").alias("node"), F.lit(0.0).alias("out"), F.col("flow").alias("into")))).alias("e")
    by_node = arcs.select("time", ends).groupBy("time", "e.node").agg(F.sum("e.out").alias("out"), F.sum("e.into").alias("into"))
    return by_node if labels is None else skewed_join(by_node, labels, ["time", "node"], "inner").groupBy("time", "label").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))


def directed_modularity(arcs: DataFrame, labels: DataFrame) -> DataFrame:
    """``time, modularity`` of ``time, node, label`` over the arcs ``time, source, target, flow``.

    The share of flow inside communities, less what would be if arcs left and entered them independently.
    """
    total = arcs.groupBy("time").agg(F.sum("flow").alias("total"))
    parts = _strengths(arcs, labels).groupBy("time").agg(F.sum(F.col("out") * F.col("into")).alias("expected"))
    a = labels.select("time", F.col("node").alias("source"), F.col("label").alias("_a"))
    b = labels.select("time", F.col("node").alias("target"), F.col("label").alias("_b"))
    both = skewed_join(skewed_join(arcs, a, ["time", "source"], "inner"), b, ["time", "target"], "inner")
    inside = both.groupBy("time").agg(F.sum(F.when(F.col("_a") == F.col("_b"), F.col("flow")).otherwise(0.0)).alias("inside"))
    joined = total.join(parts, "time").join(inside, "time")
    value = F.try_divide("inside", "total") - F.try_divide("expected", F.col("total") * F.col("total"))
    return joined.select("time", F.coalesce(value, F.lit(0.0)).alias("modularity"))


def _level(arcs: DataFrame, totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and links of a level: ``time, node, out, into, loop, total`` and ``time, node, other, flow, out, into, total``.

    A node has the flow that leaves and enters it, loops included; links go both ways and carry what their node has, so no round looks
    it up again.
    """
    loop = F.when(F.col("source") == F.col("target"), F.col("flow")).otherwise(0.0)
    ends = F.explode(F.array(F.struct(F.col("source").alias("node"), F.col("flow").alias("out"), F.lit(0.0).alias("into"), loop.alias("loop")),
                             F.struct(F.col("target").alias("node"), F.lit(0.0).alias("out"), F.col("flow").alias("into"), F.lit(0.0).alias("loop")))).alias("e")
    nodes = arcs.select("time", ends).groupBy("time", "e.node").agg(F.sum("e.out").alias("out"), F.sum("e.into").alias("into"), F.sum("e.loop").alias("loop"))
    nodes = nodes.join(totals, "time").checkpoint()
    ways = F.explode(F.array(F.struct(F.col("source").alias("node"), F.col("target").alias("other")),
                             F.struct(F.col("target").alias("node"), F.col("source").alias("other")))).alias("e")
    links = arcs.where(F.col("source") != F.col("target")).select("time", "flow", ways).select("time", "e.node", "e.other", "flow")
    return nodes, skewed_join(links, nodes.drop("loop"), ["time", "node"], "inner").checkpoint()


def _weighed(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (nodes with ``label``) with the label that gains most by each node, and the node's share in the modularity.

    ``inside`` and ``expected`` of a slice add up to the flow inside communities and the product of what leaves and enters them.
    """
    known = labels.select("time", F.col("node").alias("other"), "label")
    lone = F.lit(None).cast("double")
    heard = skewed_join(links, known, ["time", "other"], "inner").select(
        "time", "node", "label", "flow", "out", "into", "total", lone.alias("loop"), F.lit(False).alias("own")
    )
    stay = labels.select("time", "node", "label", F.lit(0.0).alias("flow"), "out", "into", "total", "loop", F.lit(True).alias("own"))
    same = [F.max(c).alias(c) for c in ("out", "into", "total", "loop", "own")]
    tally = heard.unionByName(stay).groupBy("time", "node", "label").agg(F.sum("flow").alias("flow"), *same)
    groups = labels.groupBy("time", "label").agg(F.sum("out").alias("c_out"), F.sum("into").alias("c_into"))
    scored = skewed_join(tally, groups, ["time", "label"], "inner")
    minus = F.col("own").cast("int")
    expected = F.col("out") * (F.col("c_into") - minus * F.col("into")) + F.col("into") * (F.col("c_out") - minus * F.col("out"))
    scored = scored.withColumn("gain", F.round(F.col("flow") / F.col("total") - expected / (F.col("total") * F.col("total")), 12))
    best = F.min_by("label", F.struct(-F.col("gain"), ~F.col("own"), "label")).alias("best")
    # an inner link is heard at both of its ends
    shares = {"label": F.col("label"), "loop": F.col("loop"), "inside": F.col("flow") / 2 + F.col("loop"), "expected": F.col("out") * F.col("c_into")}
    kept = [F.max(c).alias(c) for c in ("out", "into", "total")] + [F.max(F.when(F.col("own"), v)).alias(k) for k, v in shares.items()]
    return scored.groupBy("time", "node").agg(best, *kept)


def _quality(weighed: DataFrame, name: str) -> DataFrame:
    """``time`` and the directed modularity of weighed labels, as ``directed_modularity`` has it."""
    total = F.max("total")
    value = F.try_divide(F.sum("inside"), total) - F.try_divide(F.sum("expected"), total * total)
    return weighed.groupBy("time").agg(F.coalesce(value, F.lit(0.0)).alias(name))


def directed_communities(weights: DataFrame, patience: int = 2, max_rounds: int = 200) -> DataFrame:
    """``time, node, community`` by the direction of the edges ``time, source, target, weight``.

    An edge counts by the flow of a walk along it (``visit_rates``). Nodes move to the community that gains most directed modularity by
    them, half of them in a round; a slice keeps a round only if its modularity grows. When ``patience`` rounds bring no slice
    on, communities become nodes and it goes on from there, until a level moves nothing. A slice where label propagation
    does better by the same measure keeps its labels. Communities are named after their smallest node.
    Every round is cut off by a checkpoint, and all joins are shuffles that Spark can split.
    """
    ensure_checkpoints(weights.sparkSession)
    rates = visit_rates(weights, tolerance=1e-2).withColumnRenamed("node", "source")
    arcs = weights.where("weight > 0 and source is not null and target is not null").groupBy("time", "source", "target").agg(F.sum("weight").alias("weight"))
    leaving = arcs.groupBy("time", "source").agg(F.sum("weight").alias("out"))
    arcs = skewed_join(skewed_join(arcs, leaving, ["time", "source"], "inner"), rates, ["time", "source"], "inner")
    flows = arcs.select("time", "source", "target", (F.col("rate") * F.col("weight") / F.col("out")).alias("flow")).checkpoint()
    totals = flows.groupBy("time").agg(F.sum("flow").alias("total")).checkpoint()
    placed = rates.select("time", F.col("source").alias("node"), F.col("source").alias("label")).checkpoint()
    level, turn = flows, 0
    while True:
        nodes, links = _level(level, totals)
        weighed = _weighed(links, nodes.withColumn("label", F.col("node"))).checkpoint()
        score = _quality(weighed, "modularity").checkpoint()
        idle, any_move = 0, False
        while idle < patience and turn < max_rounds:
            turn += 1
            moves = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0
            moved = weighed.withColumn("label", F.when(moves, F.col("best")).otherwise(F.col("label")))
            tried = _weighed(links, moved.select("time", "node", "out", "into", "loop", "total", "label")).checkpoint()
            compared = score.join(_quality(tried, "_new"), "time").withColumn("better", F.col("_new") > F.col("modularity") + 1e-9).checkpoint()
            better = compared.where("better").select("time")
            if better.isEmpty():
                idle += 1
                continue
            idle, any_move = 0, True
            weighed = tried.join(better, "time", "left_semi").unionByName(weighed.join(better, "time", "left_anti")).checkpoint()
            score = compared.select("time", F.greatest("modularity", "_new").alias("modularity"))
        labels = weighed.select("time", "node", "label")
        if not any_move:
            break
        step = labels.select("time", F.col("node").alias("label"), F.col("label").alias("_next"))
        joined = skewed_join(placed, step, ["time", "label"])
        placed = joined.select("time", "node", F.coalesce("_next", "label").alias("label")).checkpoint()
        ends = [labels.select("time", F.col("node").alias(c), F.col("label").alias(f"_{c}")) for c in ("source", "target")]
        both = skewed_join(skewed_join(level, ends[0], ["time", "source"], "inner"), ends[1], ["time", "target"], "inner")
        level = both.groupBy("time", F.col("_source").alias("source"), F.col("_target").alias("target")).agg(F.sum("flow").alias("flow")).checkpoint()
    spread = label_propagation(weights).withColumnRenamed("community", "label")
    qualities = [directed_modularity(flows, t).withColumnRenamed("modularity", n) for t, n in ((placed, "_walk"), (spread, "_spread"))]
    worse = qualities[0].join(qualities[1], "time").where(F.col("_spread") > F.col("_walk") + 1e-9)
    final = placed.join(worse, "time", "left_anti").unionByName(spread.join(worse, "time", "left_semi"))
    names = final.groupBy("time", "label").agg(F.min("node").alias("community"))
    return skewed_join(final, names, ["time", "label"], "inner").select("time", "node", "community")
