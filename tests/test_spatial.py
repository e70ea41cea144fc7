"""Nearest nodes, points in runs, pairs of vertices and cable distances against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from axonweave.operators import graph as G
from axonweave.operators import rank as R
from axonweave.operators import relate as H

SKELETON = "body_id long, row_no long, x long, y long, z long, parent_row long"


def tree(r, body, n, step):
    """A branching curve: mostly onwards from the node before, at times from any."""
    rows = [(body, 1, 0, 0, 0, -1)]
    for i in range(2, n + 1):
        p = rows[-1] if r.random() < 0.95 else r.choice(rows)
        rows.append((body, i, *(p[2 + a] + r.randint(-step, step) for a in range(3)), p[1]))
    return rows


def test_nearest_nodes(spark):
    r = random.Random(3)
    nodes = tree(r, 1, 700, 9) + tree(r, 2, 40, 1) + [(3, 1, 5, 5, 5, -1), (3, 2, 5, 5, 5, 1), (4, 1, None, 0, 0, -1)]
    points = [(i, r.choice((1, 1, 2, 3)), *(r.choice((r.randint(-60, 60), r.randint(-4000, 4000))) for _ in range(3))) for i in range(400)]
    points += [(1000, 1, 0, 0, 0), (1001, 4, 0, 0, 0), (1002, 9, 0, 0, 0), (1003, 1, None, 0, 0)]
    got = {(x.point_id, x.body_id): (x.row_no, x.distance) for x in R.nearest_skel_node(spark.createDataFrame(nodes, SKELETON), spark.createDataFrame(points, "point_id long, body_id long, x long, y long, z long")).collect()}
    want = {}
    for i, b, *at in points:
        ds = [(sum((p - q) ** 2 for p, q in zip(at, n[2:5])), n[1]) for n in nodes if n[0] == b and None not in (*n[2:5], *at)]
        if ds:
            want[i, b] = (min(ds)[1], min(ds)[0] ** 0.5)
    assert got == want and got[1000, 1] == (1, 0.0)


def test_near_linear_work(spark):
    """Of 200,000 nodes of one body a point meets a small part."""
    nodes = spark.range(1, 200_001).selectExpr("7L AS body_id", "id AS row_no", "id * 3 AS x", "CAST(5000 * sin(id / 3000) AS BIGINT) AS y", "CAST(5000 * cos(id / 3000) AS BIGINT) AS z")
    points = spark.range(3000).selectExpr("id AS point_id", "7L AS body_id", "id * 199 AS x", "0L AS y", "id % 50 AS z")
    found = R.nearest_skel_node(nodes, points)
    assert found.count() == 3000
    key = points.where("point_id % 300 = 0").join(nodes.select("body_id", "row_no", *(F.col(c).alias(f"n{c}") for c in "xyz")), "body_id")
    d = sum(((F.col(c) - F.col(f"n{c}")) * (F.col(c) - F.col(f"n{c}")) for c in "yz"), (F.col("x") - F.col("nx")) * (F.col("x") - F.col("nx")))
    want = key.groupBy("point_id").agg(F.min(F.struct(d.alias("d"), "row_no")).alias("m")).select("point_id", "m.row_no")
    assert want.join(found, ["point_id", "row_no"]).count() == 10


def test_runs_are_covered_once(spark):
    r = random.Random(8)
    runs = [(a, a + n) for a in (-70, -3, 0, 1, 5, 64) for n in (0, 1, 2, 3, 7, 62, 63, 64, 200)] + [(5, 4), (-(2**40), 2**40)]
    rows = spark.createDataFrame(runs, "x0 long, x1 long").select("*", H.dyadic_cover(F.col("x0"), F.col("x1")).alias("c")).collect()
    for x0, x1, cover in rows:
        pieces = sorted((c.cell << c.level, (c.cell + 1) << c.level) for c in cover or [])
        assert len(pieces) <= 2 * max(x1 - x0 + 1, 1).bit_length()
        at = x0
        for low, high in pieces:
            assert low == at
            at = high
        assert at == max(x1 + 1, x0)
    assert len(rows[-1].c) <= 84
    regions = [(r.randint(0, 1), r.randint(0, 1), a, a + r.choice((0, 3, 5000)), f"r{i}") for i, a in enumerate(r.sample(range(-50, 6000), 60))] + [(0, 0, -(2**40), 2**40, "all")]
    points = [(i, r.randint(-100, 7000), r.randint(0, 1), r.randint(0, 2)) for i in range(300)] + [(900, None, 0, 0), (901, 2**39, 0, 0)]
    for scale in (0, 5):
        got = sorted((x.id, x.name) for x in H.map_points(spark.createDataFrame(points, "id long, x long, y long, z long"), spark.createDataFrame(regions, "z long, y long, x0 long, x1 long, name string"), "name", scale).select("id", F.coalesce("name", F.lit("")).alias("name")).collect())
        want = []
        for i, x, y, z in points:
            hits = [n for rz, ry, a, b, n in regions if x is not None and rz == z >> scale and ry == y >> scale and a <= x >> scale <= b]
            want += [(i, n) for n in hits or [""]]
        assert got == sorted(want)
    none = spark.createDataFrame([], "z long, y long, x0 long, x1 long, name string")
    assert H.map_points(spark.createDataFrame(points, "id long, x long, y long, z long"), none, "name").where("name IS NULL").count() == len(points)


def test_pairs_of_a_hub(spark):
    """A body with 4,000 of 4,060 vertices is many join keys, and every pair comes once."""
    rows = spark.range(4060).selectExpr("CASE WHEN id < 4000 THEN 1 ELSE id % 20 + 2 END AS body_id", "concat('v', id) AS vertex", "id AS x")
    pairs = G.pairs_within(rows, "body_id", "vertex", 256)
    n = pairs.groupBy("body_id").agg(F.count("*").alias("n"), F.sum(F.xxhash64("a.vertex", "b.vertex").cast("decimal(38,0)")).alias("h"), F.min(F.expr("a.vertex < b.vertex")).alias("ordered"))
    plain = rows.alias("a").join(rows.alias("b"), "body_id").where("a.vertex < b.vertex").groupBy("body_id").agg(F.count("*").alias("n"), F.sum(F.xxhash64("a.vertex", "b.vertex").cast("decimal(38,0)")).alias("h"))
    assert {tuple(x[:3]) for x in n.collect()} == {tuple(x) for x in plain.collect()} and n.where("NOT ordered").isEmpty()
    assert n.where("body_id = 1").first().n == 4000 * 3999 // 2


def test_cable_distances(spark):
    r = random.Random(4)
    nodes = tree(r, 1, 260, 5) + tree(r, 2, 3, 5) + [(2, 10, 1, 1, 1, -1), (2, 11, 3, 1, 1, 10), (2, 12, 9, 9, 9, 77)]
    pairs = [(1, r.randint(1, 265), r.randint(1, 265)) for _ in range(120)] + [(1, 1, 260), (2, 1, 11), (2, 10, 11), (2, 12, 12), (2, 12, 11), (3, 1, 2), (1, 500, 500)]
    by = {(n[0], n[1]): n for n in nodes}

    def ups(b, a):
        out, length = {}, 0.0
        while (b, a) in by:
            out[a] = length
            n, p = by[b, a], by.get((b, by[b, a][5]))
            if not p:
                break
            length += sum((s - t) ** 2 for s, t in zip(n[2:5], p[2:5])) ** 0.5
            a = p[1]
        return out

    got = {(x.body_id, x.a, x.b): x.distance for x in G.cable_distance(spark.createDataFrame(nodes, SKELETON), spark.createDataFrame(pairs, "body_id long, a long, b long")).collect()}
    want = {}
    for b, p, q in pairs:
        one, two = ups(b, p), ups(b, q)
        both = [one[a] + two[a] for a in one if a in two]
        want[b, p, q] = int(min(both) + 0.5) if both else None
    assert got == want and want[2, 1, 11] is None and want[2, 10, 11] == 2
    with pytest.raises(ValueError):
        G.cable_distance(spark.createDataFrame([(1, 1, 0, 0, 0, 2), (1, 2, 1, 1, 1, 1)], SKELETON), spark.createDataFrame([(1, 1, 2)], "body_id long, a long, b long"))
