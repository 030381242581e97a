import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowtide.llm import hard_negatives as mining


def brute(rows, anchor, positives=5, per_positive=5):
    kept = sorted({
        (i, y, tuple(math.floor(256 * x) for x in v)) for i, y, v in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    })
    out = []
    for i, y, v in kept:
        if not anchor(i):
            continue
        others = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in kept if j != i and len(w) == len(v)]
        others.sort()
        for p, j, _ in [o for o in others if o[2] == y][:positives]:
            hard = [o for o in others if o[2] != y and 80 * -p <= 100 * -o[0] <= 100 * -p][:per_positive]
            out += [(i, j, r + 1, o[1], -p, -o[0]) for r, o in enumerate(hard)]
    return sorted(out)


def frame(spark, rows):
    schema = "vec_id bigint, embedding array<double>, label int, anchor string, `a.b` int, block int, dim string"
    return spark.createDataFrame([(i, v, y, "x", 1, 2, "d") for i, y, v in rows], schema)


def mined(spark, rows, step=10):
    df = mining.hard_negatives(frame(spark, rows), F.col("vec_id") % step == 0, F.col("label"))
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dim,spread", [(16, 0.3), (7, 0.1), (64, 0.05), (1, 1.0)])
def test_equals_brute_force(spark, monkeypatch, dim, spread):
    """Small blocks, so every anchor meets several; clusters, copies and ties."""
    monkeypatch.setattr(mining, "BLOCK", 40)
    monkeypatch.setattr(mining, "ANCHOR_BLOCK", 7)
    pick = np.random.default_rng(dim)
    centres = pick.normal(size=(4, dim))
    rows = [(i, int(y), (0.2 * centres[(y + i % 2) % 4] + spread * pick.normal(size=dim)).tolist()) for i, y in enumerate(pick.integers(0, 4, 300))]
    rows += [(400 + i, i % 3, rows[0][2]) for i in range(40)] + [(500 + i, 3, [0.0] * dim) for i in range(11)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == want and want


def test_edge_cases(spark):
    v = [0.5, -0.25]
    rows = [(0, 1, v), (0, 1, v), (1, 1, [0.5, 0.0]), (2, 2, [0.25, 0.1]), (3, None, v), (None, 2, v), (4, 2, None), (5, 2, [None, 1.0]),
            (6, 2, [float("nan"), 1.0]), (7, 2, [float("inf"), 1.0]), (8, 2, [0.45, 0.0]), (9, 2, [0.4]), (10, 1, []), (20, 2, [])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0) != []
    assert mined(spark, []) == []
    # different rows of one id are rows of their own
    rows += [(1, 1, [0.6, 0.0]), (8, 2, [0.47, 0.0]), (8, 1, [0.45, 0.0])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_large_components_stay_exact(spark):
    pick = random.Random(3)
    rows = [(i, i % 2, [pick.uniform(-1, 1) * 2**22 for _ in range(6)]) for i in range(60)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_bounds_hold_at_every_level():
    pick = np.random.default_rng(1)
    rows = np.floor(pick.normal(size=(50, 23)) * 100)
    exact = rows @ rows[0]
    widths = []
    for level in mining.LEVELS:
        means, spreads = mining.summaries(rows, level)
        low, high = mining._band(means[0], spreads[0], means, spreads)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).sum())
    assert widths[0] > widths[1] > widths[2]


def test_least_negative_is_exact():
    for p in (0, 1, 4, 5, 10**18 + 1):
        least = mining.least_negative(p, (80, 100))
        assert 100 * least >= 80 * p > 100 * (least - 1)


def test_nulls_of_arrow_are_no_rows():
    empty = pa.table({"vec_id": pa.array([], pa.int64()), "code": pa.array([], pa.binary()), "stats": pa.array([], pa.binary())})
    assert mining.Block(empty).rows.shape == (0, 0)
