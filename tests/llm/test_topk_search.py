import math

import numpy as np
from pyspark.sql import functions as F

from axonweave.llm.topk_search import Pair, top_k


def brute(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 3 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q)
            out += [(q, r, c, -x) for r, (x, c) in enumerate(s[:k], 1)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=rng.choice([5, 8]))]) for i in range(120)]
    rows += [(200 + i, [0.5] * 8) for i in range(20)] + [(300, None), (301, [1.0, None]), (303, [float("nan")]), (306, [float("inf")]), (None, [1.0]), (309, []), (312, [-3.0] * 8)]
    for k in (1, 5, 500):
        df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, block int")
        rows32 = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
        assert sorted(map(tuple, top_k(df, F.col("vec_id") % 3 == 0, k).collect())) == brute(rows32, k)


def test_components_of_any_size(spark):
    rows = [(0, [1e300, 2.0, 0.25]), (1, [2.0**24, -1.0, 3.0]), (2, [-1e300, 5.0, 1.0]), (3, [2.0**23, 2.0**23, 1.0]), (6, [2.0**40, 1.0, 1e-3]), (7, [1.0, 1.0, 1.0]), (9, [1e305, 1e305, 0.0]), (12, [1.7e308, 0.0, 0.0])]
    want = [(q, r, c, min(max(x, -(2**63)), 2**63 - 1)) for q, r, c, x in brute(rows[:-1], 500)]
    got = sorted(map(tuple, top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 3 == 0, 500).collect()))
    assert sorted((q, c, x) for q, _, c, x in got) == sorted((q, c, x) for q, _, c, x in want)
    assert all(a[3] > b[3] or a[3] == b[3] and a[2] < b[2] for a, b in zip(got, got[1:]) if a[0] == b[0])


def test_long_vectors_and_many_blocks(spark, monkeypatch):
    import axonweave.llm.topk_search as search

    for name, n in (("QUERIES", 16), ("CANDIDATES", 32), ("STEP", 5), ("GROUP", 2)):
        monkeypatch.setattr(search, name, n)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=3000) * (i % 7)]) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 3 == 0, 4).collect())) == brute(rows, 4)


def test_safe_cutoffs_leave_most_products_out():
    """Products of phase 2 with the cutoffs of phase 1, against those without any, on vectors of differing norms."""
    rng = np.random.default_rng(1)
    c = np.floor(256 * rng.normal(size=(4096, 64)) * rng.lognormal(sigma=1, size=(4096, 1)))
    q, k = np.floor(256 * rng.normal(size=(256, 64))), 5
    exact = q @ c.T
    own = np.zeros(exact.shape, bool)
    first = Pair(q, c, 4)
    r, columns = first.heads(0, own, k)
    assert first.work <= q.size * len(c) / 4 + 1
    cutoffs = np.array([np.sort(exact[i, columns[r == i]])[-k] for i in range(len(q))])
    assert (cutoffs <= np.sort(exact, axis=1)[:, -k]).all()
    bare, safe = Pair(q, c, 4), Pair(q, c, 4)
    bare.reaching(0, own, np.full(len(q), -np.inf))
    rows, found, scores = safe.reaching(0, own, cutoffs)
    assert (scores == exact[rows, found]).all()
    assert bare.work == q.size * len(c) and safe.work < 0.6 * bare.work
    reached = np.zeros(exact.shape, bool)
    reached[rows, found] = True
    assert (reached | (exact < cutoffs[:, None])).all()


def test_empty(spark):
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 3 == 0).collect() == []


def test_no_block_passes_through_the_driver(spark):
    """Query blocks meet all candidate blocks, so a broadcast of them grows with both tables."""
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "vec_id long, embedding array<float>")
    plan = top_k(df, F.col("vec_id") % 3 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "data" in plan and "Broadcast" not in plan
