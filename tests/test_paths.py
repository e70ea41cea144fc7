"""Shortest paths that end at their farthest target, against all simple paths."""

import random

from axonweave.operators import graph as G


def simple_paths(arcs, source, target):
    best, found = None, []
    todo = [(source, (source,), 0.0)]
    while todo:
        at, path, d = todo.pop()
        if at == target:
            if best is None or d < best:
                best, found = d, []
            if d == best:
                found.append(path)
            continue
        todo += [(b, (*path, b), d + w) for (a, b), w in arcs.items() if a == at and b not in path]
    return {(source, target, best, p) for p in found}


def test_against_all_simple_paths(spark):
    r = random.Random(5)
    arcs = {}
    for _ in range(24):
        a, b = r.sample(range(9), 2)
        arcs[a, b] = float(r.choice((0, 1, 1, 2, 5)))
    conns = spark.createDataFrame([(a, b, w) for (a, b), w in arcs.items()], "pre_body long, post_body long, weight double")
    pairs = [(0, 1), (0, 7), (3, 8), (3, 2), (5, 6), (5, 99)]
    got = {(x.source, x.target, x.distance, tuple(x.path)) for x in G.shortest_paths(conns, spark.createDataFrame(pairs, "source long, target long")).collect()}
    assert got == set().union(*(simple_paths(arcs, *p) for p in pairs)) and len(got) >= 4


def test_search_from_both_ends_stays_near_them(spark):
    """Random graphs side by side, with weights of 0 and paths that tie; and a graph where all bodies are within 7 links."""
    r, arcs, pairs = random.Random(11), {}, []
    for base in range(0, 600, 100):
        for _ in range(22):
            a, b = r.sample(range(8), 2)
            arcs[base + a, base + b] = float(r.choice((0, 0, 1, 1, 2)))
        pairs += [(base + a, base + b) for a, b in (r.sample(range(8), 2) for _ in range(4))]
    conns = spark.createDataFrame([(a, b, w) for (a, b), w in arcs.items()], "pre_body long, post_body long, weight double")
    got = {(x.source, x.target, x.distance, tuple(x.path)) for x in G.shortest_paths(conns, spark.createDataFrame(pairs, "source long, target long")).collect()}
    assert got == set().union(*(simple_paths({k: w for k, w in arcs.items() if k[0] // 100 == p[0] // 100}, *p) for p in pairs)) and len(got) >= 20

    wide = spark.range(2187).selectExpr("id AS a", "explode(array(id * 3 % 2187, (id * 3 + 1) % 2187, (id * 3 + 2) % 2187)) AS b", "1.0D AS w")
    ends, ahead, behind = G._from_both_ends(spark.createDataFrame([(5, 1700)], "source long, target long"), wide)
    assert ends.count() == 1 and ahead.count() + behind.count() < 700
