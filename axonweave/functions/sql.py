"""The read operators for users of spark.sql: views of a graph, scalar functions and functions that return tables.

Table functions are filters over views that hold the answer for all bodies, so that LATERAL over many bodies becomes a join
and not a query for each. Paths along trees and between bodies need rounds and are DataFrame functions only
(`cable_distance`, `shortest_paths`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonweave.functions.columns import neuron_by_counts, register
from axonweave.operators import aggregate as A
from axonweave.operators.rank import central_synapse, neighbors
from axonweave.operators.rank import top_partners as ranked_partners

#: The view ranks all partners; functions take the first x of them.
ALL = 2**31 - 1
_VECTOR = "body_id BIGINT, inputs ARRAY<BIGINT>, outputs ARRAY<BIGINT>"
_INFO = "MAP<STRING, STRUCT<pre: BIGINT, post: BIGINT>>"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_graph(spark: SparkSession, synapses: DataFrame, edges: DataFrame, bodies: DataFrame, rois: list[str], skeleton: DataFrame | None = None, pre_hp: float = 0.2, post_hp: float = 0.8, threshold: int = 10) -> None:
    """Views graph_synapse, graph_body (with pre, post, roi_info), graph_connection, graph_partner, graph_roi_count,
    graph_category, graph_vertex and graph_skel_node, and functions on them. synapses have body_id, edges both ends
    resolved; rois is the axis of feature vectors, threshold tells neurons by their counts."""
    register(spark)
    counts, by_roi = A.body_counts(synapses), A.body_roi_counts(synapses)
    conns = A.connections(edges, pre_hp, post_hp)
    neurons = counts.where(neuron_by_counts(F.col("pre"), F.col("post"), threshold))
    views = {
        "synapse": synapses, "connection": conns, "neighbor": neighbors(conns), "partner": ranked_partners(conns, ALL), "roi_count": A.roi_counts(synapses), "category": A.connection_categories(edges, by_roi, neurons), "vertex": A.connection_vertices(edges),
        "body": bodies.drop("pre", "post", "roi_info").join(counts, "body_id", "left").join(A.as_roi_info(by_roi, ["body_id"]), "body_id", "left"), "central": central_synapse(synapses, A.centroid(synapses), bodies),
    } | ({"skel_node": skeleton} if skeleton is not None else {})
    for name, df in views.items():
        df.createOrReplaceTempView(f"graph_{name}")

    axis = f"array({', '.join(map(_literal, sorted(rois)))})"
    dense = lambda field: f"transform({axis}, r -> coalesce(try_element_at(roi_info, r).{field}, 0L))"
    vectors = f"SELECT body_id, {dense('post')} AS inputs, {dense('pre')} AS outputs FROM graph_body"
    there = "coalesce(try_element_at(roi_info, region).pre + try_element_at(roi_info, region).post, 0L) > least_in_region AND pre + post > least"
    point = "STRUCT<x: BIGINT, y: BIGINT, z: BIGINT>"
    functions = [
        f"point3d(x BIGINT, y BIGINT, z BIGINT) RETURNS {point} RETURN IF(x IS NULL OR y IS NULL OR z IS NULL, NULL, named_struct('x', x, 'y', y, 'z', z))",
        f"roi_info_as_sub_name(info {_INFO}, pre BIGINT, post BIGINT, threshold DOUBLE, every ARRAY<STRING>, super ARRAY<STRING>) RETURNS STRING RETURN roi_info_as_name(info, pre, post, threshold, array_except(every, super))",
        f"neuron_centroid(body BIGINT) RETURNS {point} RETURN (SELECT any_value(named_struct('x', x, 'y', y, 'z', z)) FROM graph_central WHERE body_id = body)",
        "segment_rois(body BIGINT) RETURNS ARRAY<STRING> RETURN (SELECT any_value(array_sort(map_keys(roi_info))) FROM graph_body WHERE body_id = body)",
        "synapse_rois(px BIGINT, py BIGINT, pz BIGINT) RETURNS ARRAY<STRING> RETURN (SELECT array_sort(array_distinct(flatten(collect_list(rois)))) FROM graph_synapse WHERE x = px AND y = py AND z = pz)",
        "roi_counts(body BIGINT) RETURNS TABLE (roi STRING, inputs BIGINT, outputs BIGINT) RETURN SELECT roi, inputs, outputs FROM graph_roi_count WHERE body_id = body",
        "connection_categories(body BIGINT) RETURNS TABLE (category STRING, pre BIGINT, post BIGINT) RETURN SELECT category, pre, post FROM graph_category WHERE body_id = body",
        "top_partners(body BIGINT, x INT) RETURNS TABLE (partner BIGINT, is_out BOOLEAN, weight BIGINT) RETURN SELECT partner, is_out, weight FROM graph_partner WHERE body_id = body AND rank <= x",
        f"feature_vectors(least BIGINT) RETURNS TABLE ({_VECTOR}) RETURN {vectors} WHERE pre + post > least",
        f"feature_vectors_in(region STRING, least_in_region BIGINT, least BIGINT) RETURNS TABLE ({_VECTOR}) RETURN {vectors} WHERE {there}",
        f"""feature_vectors_topx(region STRING, least_in_region BIGINT, least BIGINT, x INT) RETURNS TABLE ({_VECTOR}, input_ids ARRAY<BIGINT>, output_ids ARRAY<BIGINT>, is_primary BOOLEAN) RETURN
            WITH chosen AS ({vectors} WHERE {there}),
            best AS (SELECT p.body_id, p.partner, p.is_out FROM graph_partner p LEFT SEMI JOIN chosen ON p.body_id = chosen.body_id WHERE p.rank <= x),
            sets AS (SELECT body_id, sort_array(collect_set(IF(is_out, NULL, partner))) AS input_ids, sort_array(collect_set(IF(is_out, partner, NULL))) AS output_ids FROM best GROUP BY body_id),
            others AS (SELECT DISTINCT partner FROM best WHERE partner NOT IN (SELECT body_id FROM chosen))
            SELECT c.body_id, c.inputs, c.outputs, coalesce(s.input_ids, array()), coalesce(s.output_ids, array()), true FROM chosen c LEFT JOIN sets s ON s.body_id = c.body_id
            UNION ALL SELECT v.body_id, v.inputs, v.outputs, array(), array(), false FROM ({vectors} WHERE pre + post >= 0) v LEFT SEMI JOIN others ON others.partner = v.body_id""",
        "connection_centroids(body BIGINT, least BIGINT) RETURNS TABLE (vertex STRING, pre BIGINT, post BIGINT, x BIGINT, y BIGINT, z BIGINT) RETURN SELECT concat(pre_body, '_', post_body), pre, post, x, y, z FROM graph_vertex WHERE (pre_body = body OR post_body = body) AND pre + post > least",
        """line_graph(body BIGINT, least BIGINT) RETURNS TABLE (source STRING, target STRING, distance BIGINT) RETURN
            WITH own AS (SELECT concat(pre_body, '_', post_body) AS v, x, y, z FROM graph_vertex WHERE (pre_body = body OR post_body = body) AND pre + post > least)
            SELECT a.v, b.v, CAST(floor(point_distance(a.x, a.y, a.z, b.x, b.y, b.z) + 0.5D) AS BIGINT) FROM own a JOIN own b ON a.v < b.v""",
    ]
    if skeleton is not None:
        functions += [
            "body_skeleton(body BIGINT) RETURNS TABLE (row_no BIGINT, x BIGINT, y BIGINT, z BIGINT, parent_row BIGINT) RETURN SELECT row_no, x, y, z, parent_row FROM graph_skel_node WHERE body_id = body",
            "nearest_skel_node(body BIGINT, px BIGINT, py BIGINT, pz BIGINT) RETURNS TABLE (row_no BIGINT, distance DOUBLE) RETURN SELECT row_no, point_distance(x, y, z, px, py, pz) FROM graph_skel_node WHERE body_id = body ORDER BY (x - px) * (x - px) + (y - py) * (y - py) + (z - pz) * (z - pz), row_no LIMIT 1",
        ]
    for f in functions:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {f}")
