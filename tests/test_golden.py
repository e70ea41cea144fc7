"""Golden values of a small dataset: nine listed synapses, seven links, ten bodies."""

import pytest
from pyspark.sql import functions as F

from axonweave.functions import columns as C
from axonweave.operators import aggregate as A
from axonweave.operators import graph as G
from axonweave.operators import rank as R
from axonweave.operators import relate as H
from axonweave.plans.load import derive, owned_synapses

S = "seven_column_roi"
SYNAPSES = [
    ("pre", 4287, 2277, 1542, 1.0, [S, "roiA"]), ("pre", 4287, 2277, 1502, 1.0, [S, "roiA"]), ("pre", 4300, 2000, 1500, 1.0, [S, "roiA"]),
    ("post", 4222, 2402, 1688, 1.0, ["roiA", "roiB"]), ("post", 8000, 7000, 6000, 0.9, [S, "roiA"]), ("post", 4000, 5000, 6000, 0.8, [S, "roiA"]),
    ("post", 4301, 2276, 1535, 0.1, [S, "roiA"]), ("post", 4298, 2294, 1542, 1.0, [S, "roiB"]), ("post", 4292, 2261, 1542, 1.0, [S, "roiA", "roiB", "roi'C"]),
]
LINKS = [
    ((4287, 2277, 1542), (4298, 2294, 1542)), ((4287, 2277, 1542), (4301, 2276, 1535)), ((4287, 2277, 1502), (4292, 2261, 1542)), ((4287, 2277, 1502), (8000, 7000, 6000)),
    ((4300, 2000, 1500), (4222, 2402, 1688)), ((4300, 2000, 1500), (4000, 5000, 6000)), ((100, 200, 300), (4300, 2000, 1500)),
]
OWNERS = {8426959: [(4287, 2277, 1542), (4222, 2402, 1688), (4287, 2277, 1502), (8000, 7000, 6000), (4000, 5000, 6000)], 26311: [(4301, 2276, 1535), (4300, 2000, 1500)], 2589725: [(4298, 2294, 1542)], 831744: [(4292, 2261, 1542)]}
BODIES = [*OWNERS, 1, 2, 3, 4, 5, 6]


@pytest.fixture(scope="module")
def graph(spark):
    place = "struct<x:bigint,y:bigint,z:bigint>"
    synapse = spark.createDataFrame(SYNAPSES, "type string, x long, y long, z long, confidence double, rois array<string>").withColumn("rois", C.known_rois(F.col("rois")))
    links = spark.createDataFrame(LINKS, f"pre {place}, post {place}")
    synapse = R.numbered(H.upsert_endpoints(links, synapse), ["x", "y", "z", "type"], 1).cache()
    at = lambda s: synapse.where(F.col("type") == s).select(F.struct("x", "y", "z").alias(s), F.col("syn_id").alias(f"{s}_id"))
    edges = links.join(at("pre"), "pre").join(at("post"), "post").select("pre_id", "post_id")
    member = spark.createDataFrame([(b, *p) for b, ps in OWNERS.items() for p in ps], "body_id long, x long, y long, z long")
    body = spark.createDataFrame([(b,) for b in BODIES], "body_id long")
    return {"synapse": synapse, "syn_edge": edges.cache(), "membership": H.by_place(member, synapse).cache(), "body": body}


@pytest.fixture(scope="module")
def edges(graph):
    return H.resolve_edges(graph["syn_edge"], owned_synapses(graph)).cache()


def test_counts(graph):
    total = A.meta_totals(graph["synapse"]).first()
    assert (total.total_pre, total.total_post) == (4, 7) and graph["syn_edge"].count() == 7
    info = {r.body_id: r for r in derive(graph, threshold=5)["body_info"].collect()}
    assert (info[8426959].pre, info[8426959].post) == (2, 3)
    assert {k: (v.pre, v.post) for k, v in info[8426959].roi_info.items()} == {"roiA": (2, 3), "roiB": (0, 1)}
    assert info[8426959].cluster_name == "roiA.roiB-roiA" and info[8426959].is_neuron
    assert info[1].pre is None and not info[1].is_neuron


def test_connections(graph, edges):
    rows = {(r.pre_body, r.post_body): r for r in derive(graph, 0.2, 0.8)["connection"].collect()}
    assert {k: r.weight for k, r in rows.items()} == {(8426959, 2589725): 1, (8426959, 26311): 1, (8426959, 831744): 1, (8426959, 8426959): 1, (26311, 8426959): 2}
    assert rows[8426959, 26311].roi_info["roiA"].asDict() == {"pre": 1, "post": 1, "preHP": 1, "postHP": 0}
    assert rows[26311, 8426959].weight_hp == 1  # a confidence at the threshold is not above it
    at_threshold = {(r.pre_body, r.post_body): r.weight_hp for r in A.connections(edges, 0.2, 0.8, hp_rule="post_ge").collect()}
    assert at_threshold[26311, 8426959] == 2


def test_dataset_regions(graph, spark):
    rois = spark.createDataFrame([("roiA",), ("roiB",), ("roi'C",), ("never",)], "name string")
    got = {r.roi: (r.pre, r.post) for r in A.meta_roi(graph["synapse"], rois, "test").collect()}
    assert got == {"roiA": (3, 5), "roiB": (0, 3), "roi'C": (0, 1), "never": (0, 0), "test": (4, 7)}
    assert {r.roi for r in A.super_level_rois(graph["synapse"]).collect()} == {"roiA", "roiB"}


def test_names_categories_vectors(graph, edges):
    synapses = owned_synapses(graph)
    by_roi, counts = A.body_roi_counts(synapses), A.body_counts(synapses)
    named = counts.join(A.as_roi_info(by_roi, ["body_id"]), "body_id").where("body_id = 8426959")
    name = lambda t: named.select(C.region_name(F.col("roi_info"), F.col("pre"), F.col("post"), t, F.array(F.lit("roiA"))).alias("n")).first().n
    assert (name(0.05), name(1.0)) == ("roiA-roiA", "none-none")
    neurons = counts.where(C.neuron_by_counts(F.col("pre"), F.col("post"), 5) | F.lit(True))
    got = {r.category: (r.pre, r.post) for r in A.connection_categories(edges, by_roi, neurons).where("body_id = 8426959").collect()}
    assert sum(p for p, _ in got.values()) >= 2 and sum(q for _, q in got.values()) >= 2
    vector = A.feature_vectors(counts, by_roi, ["roiA", "roiB", "roi'C"]).where("body_id = 8426959").first()
    assert (vector.inputs, vector.outputs) == ([0, 3, 1], [0, 2, 0])


def test_central_synapse_and_top_regions(graph):
    synapses = owned_synapses(graph).where("body_id IS NOT NULL")
    r = R.central_synapse(synapses, A.centroid(synapses), graph["body"])
    got = {x.body_id: (x.x, x.y, x.z) for x in r.collect()}
    assert got[8426959] == (4222, 2402, 1688) and got[1] == (0, 0, 0)
    assert R.top_roi(A.body_roi_counts(synapses), "post").where("body_id = 831744").first().roi == "roi'C"  # a tie goes to the smaller name


def test_place_that_is_pre_and_post(edges):
    """The sum over the union of places is divided by the two counts."""
    v = A.connection_vertices(edges).where("pre_body = 26311").first()
    assert (v.pre, v.post) == (1, 2) and v.x == (4300 + 4222 + 4000 + 1) // 3


SKELETON = [(1, 5464, 9385, 1248, -1), (2, 5456, 9385, 1248, 1), (3, 5400, 9393, 1248, 2), (4, 5376, 9401, 1280, 3), (5, 5328, 9385, 1368, 4), (6, 1, 1, 1, -1), (7, 2, 1, 1, 6), (8, 5328, 9385, 1378, 4)]


def test_cable_distance(spark):
    skel = spark.createDataFrame([(101, r, x, y, z, p) for r, x, y, z, p in SKELETON], "body_id long, row_no int, x long, y long, z long, parent_row int")
    pairs = spark.createDataFrame([(101, 1, 5), (101, 5, 1), (101, 5, 8), (101, 3, 3), (101, 2, 7), (101, 2, 99)], "body_id long, a int, b int")
    got = {(r.a, r.b): r.distance for r in G.cable_distance(skel, pairs).collect()}
    assert got == {(1, 5): 207, (5, 1): 207, (5, 8): 212, (3, 3): 0, (2, 7): None, (2, 99): None}
    near = R.nearest_skel_node(skel, spark.createDataFrame([(7, 101, 5377, 9400, 1279)], "point_id long, body_id long, x long, y long, z long")).first()
    assert near.row_no == 4
    assert A.skeleton_stats(skel).first().roots == 2 and G.skeleton_links(skel).count() == 6


def test_shortest_paths(spark):
    rows = [(1, 2, 5.0), (2, 4, 5.0), (1, 3, 4.0), (3, 4, 6.0), (1, 4, 1.0), (4, 5, 2.0), (6, 1, 3.0), (2, 3, 0.0)]
    conns = spark.createDataFrame(rows, "pre_body long, post_body long, weight double")
    pairs = spark.createDataFrame([(1, 4), (1, 5), (5, 1), (1, 1)], "source long, target long")
    got = sorted((r.source, r.target, r.distance, tuple(r.path)) for r in G.shortest_paths(conns, pairs, least=2.0).collect())
    assert got == [(1, 4, 10.0, (1, 2, 4)), (1, 4, 10.0, (1, 3, 4)), (1, 5, 12.0, (1, 2, 4, 5)), (1, 5, 12.0, (1, 3, 4, 5))]
    back = G.shortest_paths(conns, pairs, least=2.0, direction="in").collect()
    assert {(r.source, r.target) for r in back} == {(5, 1)}
    assert len(G.shortest_paths(conns, pairs, direction="both").where("source = 1 AND target = 4").collect()) == 1
    with pytest.raises(ValueError):
        G.shortest_paths(conns.unionByName(spark.createDataFrame([(7, 8, -1.0)], conns.schema)), pairs, threshold="pre_body", least=0)


def test_line_graph_with_cable(spark, edges):
    bodies = spark.createDataFrame([(8426959,)], "body_id long")
    skel = spark.createDataFrame([(8426959, r, x, y, z, p) for r, x, y, z, p in SKELETON], "body_id long, row_no int, x long, y long, z long, parent_row int")
    vertices, pairs = G.line_graph(edges, bodies, 0, skel)
    assert vertices.count() == 5 and pairs.count() == 10
    assert pairs.where("source >= target").count() == 0 and "cable_distance" in pairs.columns


def test_pairs_are_shuffled_once(spark):
    """Links are counted by pair alike for both directions, and undirected pairs are told apart before they are turned."""
    from axonweave.operators import relate as H

    conns = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (4, 1)], "pre_body long, post_body long")
    pairs = H.all_pairs_once(conns)
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (1, 4), (2, 1), (3, 3), (4, 1)] and "Union" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    by_roi, neurons = spark.createDataFrame([(1, "A", 1, 0), (2, "B", 0, 1)], "body_id long, roi string, pre long, post long"), spark.createDataFrame([(1,), (2,), (4,)], "body_id long")
    found = A.connection_categories(conns, by_roi, neurons)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [pre_body") == 2
    assert sorted(map(tuple, found.collect())) == [(1, "B", 1, 1), (1, "None", 1, 0), (2, "A", 1, 1), (4, "A", 0, 1)]
