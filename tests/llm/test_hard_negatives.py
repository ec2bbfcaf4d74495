import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import hard_negatives as op

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100):
    """All scores with Python integers."""
    good = {(i, l, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for i, l, v in good:
        if i % every:
            continue
        others = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in good if j != i and len(w) == len(v)]
        near = sorted({(-s, j) for s, j, m in others if m == l})[:5]
        for ps, p in near:
            far = sorted({(-s, j) for s, j, m in others if m != l and 30 * -ps <= 100 * s <= 90 * -ps})[:10]
            out |= {(i, p, r, j, -ps, -s) for r, (s, j) in enumerate(far, 1)}
    return out


def table(seed, n, dim=6, labels=4, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.2, spread) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


def run(spark, rows, every=100, **kw):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as shard", "2 as part", "'a' as id", "0 as v", "3 as score")
    return [tuple(r) for r in op.mine(df, df.filter(F.col("vec_id") % every == 0), F.col("label"), **kw).collect()]


@pytest.mark.parametrize("seed, shard, part, every", [(1, 16384, 16384, 20), (2, 40, 7, 10), (3, 25, 1000, 5)])
def test_against_brute_force(spark, seed, shard, part, every):
    rows = table(seed, 400)
    got = run(spark, rows, every, shard=shard, part=part)
    assert len(got) == len(set(got)) and set(got) == brute(rows, every) and got


def test_ties_copies_and_a_hot_label(spark):
    rng = random.Random(5)
    rows = [(i, [1.0, 0.5, 0.25], 0) for i in range(200)]  # a third: one vector, one label
    rows += [(200 + i, [rng.choice([0.0, 0.25, 0.5]) for _ in range(3)], rng.randrange(3)) for i in range(400)]
    rows += rows[::7]  # repeated rows
    got = run(spark, rows, 20, shard=30, part=9)
    assert len(got) == len(set(got)) and set(got) == brute(rows, 20) and got


def test_hard_rows(spark):
    rows = table(6, 60, labels=2)
    rows += [(100, None, 1), (None, [1.0] * 6, 1), (200, [1.0] * 6, None), (300, [float("nan")] * 6, 1), (400, [None] * 6, 0),
             (500, [float("inf")] * 6, 0), (600, [0.0] * 6, 1), (601, [-0.0] * 6, 0), (700, [1.0, 2.0], 1), (701, [2.0, 1.0], 1),
             (702, [1.0, 1.0], 0), (800, [], 1), (801, [], 1), (802, [], 0), (0, [0.3] * 6, 1), (900, [0.1] * 6, 7)]
    got = run(spark, rows)
    assert set(got) == brute(rows) and {600, 700, 800} <= {g[0] for g in got}
    assert run(spark, [(None, None, None)]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert op.mine(empty, empty, F.col("label")).collect() == []


def test_large_components_are_exact(spark):
    rows = [(i, [x * 2.0**23, -x * 2.0**22, 1.0 + i], i % 2) for i, x in enumerate(np.linspace(0.5, 1.0, 60).tolist())]
    got = run(spark, rows, 10)
    assert set(got) == brute(rows, 10) and max(g[4] for g in got) > 2**60


def test_scores_past_a_long_are_held_at_its_end(spark):
    rows = [(i, [1e200 * (i + 1), 1e300], i % 2) for i in range(0, 40)]
    got = run(spark, rows, 20)  # all scores tie at the end of the range
    top = 2**63 - 1
    assert {g[4] for g in got} == {top} or got == []


def test_threshold_stops_early_and_strictly():
    """Reading stops before the lists end, and not while the threshold equals the kth score."""
    rng = np.random.default_rng(1)
    vectors = op.whole(rng.normal(size=(4000, 3)))
    shard = op.Shard(np.zeros(4000, np.int64), np.arange(4000)[:, None], np.ones(4000, np.int32), vectors,
                     np.argsort(-vectors.T, axis=1, kind="stable"))
    anchor = op.whole(np.array([0.9, -0.4, 0.1]))
    read = [len(f) for f, _ in shard.visits(anchor)]
    takes = np.ones(4000, bool)
    seen = []
    plain = shard.visits
    shard.visits = lambda a: (seen.append(len(f)) or (f, t) for f, t in plain(a))
    (ids, value), = shard.best(anchor, -1, takes, [(op.LEAST, op.MOST)], 5)
    every = op.scores(vectors, anchor)
    order = np.lexsort((np.arange(4000), -every))[:5]
    assert ids.tolist() == order.tolist() and value.tolist() == every[order].tolist()
    assert sum(seen) < sum(read) == 4000
    same = op.Shard(np.zeros(100, np.int64), np.arange(100)[::-1, None].copy(), np.ones(100, np.int32), np.full((100, 2), 3.0),
                    np.tile(np.arange(100), (2, 1)))
    (ids, _), = same.best(np.array([1.0, 1.0]), -1, np.ones(100, bool), [(op.LEAST, op.MOST)], 5)
    assert ids.tolist() == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("score", [-101, -100, -1, 0, 1, 3, 10, 99, 100, 12345, 2**62])
def test_window_ends(score):
    low, high = op.window(score)
    near = {s for e in (low, high) for s in range(e - 3, e + 4)}
    assert all((30 * score <= 100 * s <= 90 * score) == (low <= s <= high) for s in near)
