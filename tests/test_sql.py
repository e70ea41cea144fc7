"""SQL functions on a small graph."""

import pytest

from axonweave.functions.sql import register_graph
from axonweave.operators.relate import resolve_edges, with_bodies
from axonweave.schemas import MEMBERSHIP, SYN_EDGE, SYNAPSE


@pytest.fixture(scope="module")
def sql(spark):
    synapse = spark.createDataFrame([(1, 0, 0, 0, "pre", 0.9, ["A", "a1"]), (2, 4, 0, 0, "post", 0.9, ["A"]), (3, 8, 0, 0, "post", 0.1, ["it's"]), (4, 20, 0, 0, "pre", 0.9, [])], SYNAPSE)
    owned = with_bodies(synapse, spark.createDataFrame([(10, 1), (20, 2), (20, 3), (10, 4)], MEMBERSHIP))
    edges = resolve_edges(spark.createDataFrame([(1, 2), (1, 3), (4, 3)], SYN_EDGE), owned)
    bodies = spark.createDataFrame([(10, "x"), (20, "y"), (30, None)], "body_id long, name string")
    skeleton = spark.createDataFrame([(10, 1, 0, 0, 0, -1), (10, 2, 10, 0, 0, 1), (10, 3, 10, 0, 0, 2)], "body_id long, row_no long, x long, y long, z long, parent_row long")
    register_graph(spark, owned, edges, bodies, ["A", "a1", "it's"], skeleton)
    return lambda text: sorted(map(tuple, spark.sql(text).collect()), key=lambda r: tuple(map(str, r)))


def test_table_functions(sql):
    assert sql("SELECT * FROM roi_counts(20)") == [("A", 1, 0), ("it's", 1, 0), ("total", 2, 0)]
    assert sql("SELECT * FROM roi_counts(30)") == []
    assert sql("SELECT * FROM feature_vectors(1)") == [(10, [0, 0, 0], [1, 1, 0]), (20, [1, 0, 1], [0, 0, 0])]
    assert sql("SELECT body_id FROM feature_vectors_in('it''s', 0, 0)") == [(20,)]
    assert sql("SELECT body_id, input_ids, output_ids, is_primary FROM feature_vectors_topx('a1', 0, 0, 5)") == [(10, [], [20], True), (20, [], [], False)]
    assert sql("SELECT * FROM top_partners(20, 1)") == [(10, False, 2)] and sql("SELECT * FROM top_partners(20, 0)") == []
    assert sql("SELECT vertex, pre, post FROM connection_centroids(20, 0)") == [("10_20", 2, 2)]
    assert sql("SELECT * FROM line_graph(20, 0)") == []
    assert sql("SELECT row_no FROM body_skeleton(10)") == [(1,), (2,), (3,)]
    assert sql("SELECT * FROM nearest_skel_node(10, 9, 0, 0)") == [(2, 1.0)]


def test_scalar_functions(sql):
    assert sql("SELECT point3d(1, 2, 3).y, point3d(1, NULL, 3) IS NULL") == [(2, True)]
    assert sql("SELECT synapse_rois(0, 0, 0), synapse_rois(9, 9, 9)") == [(["A", "a1"], [])]
    assert sql("SELECT segment_rois(20), segment_rois(99)") == [(["A", "it's"], None)]
    assert sql("SELECT neuron_centroid(20).x, neuron_centroid(30).x") == [(4, 0)]
    assert sql("SELECT roi_info_as_sub_name(roi_info, pre, post, 0.2D, array('A', 'a1'), array('A')) FROM graph_body WHERE body_id = 10") == [("none-a1",)]
