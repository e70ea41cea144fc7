"""Registered queries: one for each operator that runs on the canonical tables, with DuckDB SQL where it can say
the same. Maps and arrays are shown in long form or as text, so that both engines compare."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from axonweave.functions import columns as C
from axonweave.functions.sql import register_graph
from axonweave.operators import aggregate as A
from axonweave.operators import graph as G
from axonweave.operators import rank as R
from axonweave.operators import relate as H
from axonweave.operators import validate as V
from axonweave.plans import edits as K
from axonweave.plans.changes import last_edit_of
from axonweave.plans.load import derive
from axonweave.plans.project import ORACLE, Tables
from axonweave.schemas import EDIT
from axonweave.streaming.feed import apply_batch, freshness, load_snapshot, save_snapshot

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of Tables; sql continues the common projections of the tables."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE_SQL[f.__name__] = f"WITH RECURSIVE {ORACLE} {sql}"
        return f

    return add


# Connections, counts and region maps


@query("SELECT pre_body, post_body, weight, weight_hp FROM conn")
def e01_connections(t: Tables) -> DataFrame:
    return A.connections(t.edges, 0.2, 0.8)


@query("SELECT pre_body, post_body, count(*) AS weight, count(*) FILTER (pre_conf > 0.2 AND post_conf > 0.8) AS weight_hp FROM edge GROUP BY ALL")
def e02_connections_by_edges(t: Tables) -> DataFrame:
    return A.connections(t.edges, 0.2, 0.8, weight_mode="edges", hp_rule="both_gt")


@query("""SELECT pre_body, post_body, roi, count(*) FILTER (side = 'pre') AS pre, count(*) FILTER (side = 'post') AS post,
    count(*) FILTER (side = 'pre' AND confidence > 0.2) AS pre_hp, count(*) FILTER (side = 'post' AND confidence > 0.8) AS post_hp
    FROM (SELECT DISTINCT pre_body, post_body, pre_id AS syn_id, 'pre' AS side FROM edge UNION ALL SELECT DISTINCT pre_body, post_body, post_id, 'post' FROM edge)
    JOIN syn_roi USING (syn_id) GROUP BY ALL""")
def e03_connection_roi(t: Tables) -> DataFrame:
    return A.connection_roi(t.edges, 0.2, 0.8)


@query("SELECT body_id, pre, post FROM body_n")
def e04_body_counts(t: Tables) -> DataFrame:
    return A.body_counts(t.synapse)


@query("SELECT body_id, roi, pre, post FROM body_roi")
def e05_body_roi_counts(t: Tables) -> DataFrame:
    return A.body_roi_counts(t.synapse)


@query("SELECT count(*) FILTER (type = 'pre') AS total_pre, count(*) FILTER (type = 'post') AS total_post FROM synapse")
def e06_meta_totals(t: Tables) -> DataFrame:
    return A.meta_totals(t.synapse)


@query("""SELECT name AS roi, coalesce(pre, 0) AS pre, coalesce(post, 0) AS post
    FROM (SELECT r_name AS name FROM region UNION SELECT n_name FROM nation)
    LEFT JOIN (SELECT roi AS name, count(*) FILTER (type = 'pre') AS pre, count(*) FILTER (type = 'post') AS post FROM syn_roi GROUP BY roi) USING (name)
    UNION ALL SELECT 'brain', count(*) FILTER (type = 'pre'), count(*) FILTER (type = 'post') FROM synapse""")
def e07_meta_roi(t: Tables) -> DataFrame:
    return A.meta_roi(t.synapse, t.roi, "brain")


@query("SELECT DISTINCT super_roi AS roi FROM synapse")
def e08_super_level_rois(t: Tables) -> DataFrame:
    return A.super_level_rois(t.synapse)


@query("""SELECT coalesce(roi, '') AS roi, count(*) FILTER (type = 'pre') AS pre, count(*) FILTER (type = 'post') AS post, coalesce(roi IN (SELECT super_roi FROM synapse), false) AS is_super
    FROM (SELECT type, roi FROM syn_roi UNION ALL SELECT type, NULL FROM synapse) GROUP BY roi""")
def e08_summary_of_loads(t: Tables) -> DataFrame:
    """Three loads, each summed up on its own, then put together."""
    loads = [A.load_summary(t.synapse.where(F.col("x") % 3 == k)) for k in range(3)]
    return A.merged_summaries(A.merged_summaries(*loads[:2]), loads[2]).withColumn("roi", F.coalesce("roi", F.lit("")))


@query("""SELECT body_id, coalesce(downstream, 0) AS downstream, coalesce(upstream, 0) AS upstream
    FROM (SELECT pre_body AS body_id, count(*) AS downstream FROM edge GROUP BY 1) FULL JOIN (SELECT post_body AS body_id, count(*) AS upstream FROM edge GROUP BY 1) USING (body_id)""")
def e09_partner_counts(t: Tables) -> DataFrame:
    return A.partner_counts(t.edges)


@query("SELECT pre_body AS body_id, roi, count(*) AS downstream FROM edge JOIN syn_roi ON pre_id = syn_id GROUP BY ALL")
def e09_downstream_by_roi(t: Tables) -> DataFrame:
    return A.downstream_by_roi(t.edges)


@query("""SELECT set_id, roi, count(*) AS weight, count(*) FILTER (confidence > limit_) AS weight_hp
    FROM (SELECT concat(pre_body, '_', post_body, '_pre') AS set_id, pre_id AS syn_id, 0.2 AS limit_ FROM edge UNION ALL SELECT concat(post_body, '_', pre_body, '_post'), post_id, 0.8 FROM edge)
    JOIN syn_roi USING (syn_id) GROUP BY ALL""")
def e10_synapse_set_roi_counts(t: Tables) -> DataFrame:
    return A.synapse_set_roi_counts(t.edges, 0.2, 0.8)


@query("SELECT body_id, roi, post AS inputs, pre AS outputs FROM body_roi UNION ALL SELECT body_id, 'total', post, pre FROM body_n")
def e11_roi_counts(t: Tables) -> DataFrame:
    return A.roi_counts(t.synapse)


def _vectors(rows: DataFrame, *more: str) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return rows.select("body_id", text("inputs"), text("outputs"), *more)


def _axis(t: Tables) -> list[str]:
    """The regions, a table of fixed size."""
    return sorted({r.name for r in t.roi.select("name").collect()})


_AXIS = """axis AS (SELECT DISTINCT name AS roi FROM (SELECT r_name AS name FROM region UNION SELECT n_name FROM nation)),
    vec AS (SELECT b.body_id, string_agg(CAST(coalesce(m.post, 0) AS VARCHAR), ',' ORDER BY a.roi) AS inputs, string_agg(CAST(coalesce(m.pre, 0) AS VARCHAR), ',' ORDER BY a.roi) AS outputs
        FROM body_n b CROSS JOIN axis a LEFT JOIN body_roi m ON m.body_id = b.body_id AND m.roi = a.roi GROUP BY b.body_id)"""


@query(f", {_AXIS} SELECT vec.* FROM vec JOIN body_n USING (body_id) WHERE pre + post > 20")
def e12_feature_vectors(t: Tables) -> DataFrame:
    return _vectors(A.feature_vectors(A.body_counts(t.synapse), A.body_roi_counts(t.synapse), _axis(t), threshold=20))


@query(f", {_AXIS} SELECT vec.* FROM vec JOIN body_n b USING (body_id) JOIN body_roi r USING (body_id) WHERE b.pre + b.post > 20 AND r.roi = 'ASIA' AND r.pre + r.post > 5")
def e13_feature_vectors_in_roi(t: Tables) -> DataFrame:
    return _vectors(A.feature_vectors(A.body_counts(t.synapse), A.body_roi_counts(t.synapse), _axis(t), "ASIA", 5, 20))


_NEAR = "near AS (SELECT pre_body AS body_id, post_body AS partner, true AS is_out, weight FROM conn UNION ALL SELECT post_body, pre_body, false, weight FROM conn)"
_TOP = f"{_NEAR}, top AS (SELECT *, row_number() OVER (PARTITION BY body_id ORDER BY weight DESC, partner, is_out DESC) AS rank FROM near)"


@query(f""", {_AXIS}, {_TOP}, chosen AS (SELECT vec.* FROM vec JOIN body_n b USING (body_id) JOIN body_roi r USING (body_id) WHERE b.pre + b.post > 20 AND r.roi = 'ASIA' AND r.pre + r.post > 8),
    best AS (SELECT t.* FROM top t JOIN chosen USING (body_id) WHERE rank <= 5)
    SELECT body_id, inputs, outputs, coalesce(string_agg(DISTINCT CAST(partner AS VARCHAR), ',' ORDER BY CAST(partner AS VARCHAR)) FILTER (NOT is_out), '') AS input_ids,
        coalesce(string_agg(DISTINCT CAST(partner AS VARCHAR), ',' ORDER BY CAST(partner AS VARCHAR)) FILTER (is_out), '') AS output_ids, true AS is_primary
    FROM chosen LEFT JOIN best USING (body_id) GROUP BY body_id, inputs, outputs
    UNION ALL SELECT body_id, inputs, outputs, '', '', false FROM vec WHERE body_id IN (SELECT partner FROM best) AND body_id NOT IN (SELECT body_id FROM chosen)""")
def e14_feature_vectors_topx(t: Tables) -> DataFrame:
    conns = A.connections(t.edges, 0.2, 0.8)
    rows = A.feature_vectors_topx(A.body_counts(t.synapse), A.body_roi_counts(t.synapse), conns, _axis(t), 5, "ASIA", 8, 20)
    text = lambda c: F.array_join(F.array_sort(F.transform(c, lambda x: x.cast("string"))), ",")
    return _vectors(rows.withColumns({"i": text("input_ids"), "o": text("output_ids")}), "i", "o", "is_primary").withColumnsRenamed({"i": "input_ids", "o": "output_ids"})


_BEST = """best AS (SELECT body_id, min_by(roi, {'a': -pre, 'b': roi}) AS out_roi, min_by(roi, {'a': -post, 'b': roi}) AS in_roi FROM body_roi GROUP BY body_id),
    neuron AS (SELECT body_id FROM body_n WHERE pre >= 2 OR post >= 10)"""


@query(f""", {_BEST} SELECT body_id, category, count(*) FILTER (side = 'pre') AS pre, count(*) FILTER (side = 'post') AS post FROM (
    SELECT pre_body AS body_id, coalesce(out_roi, 'None') AS category, 'post' AS side FROM edge JOIN neuron n ON n.body_id = post_body LEFT JOIN best b ON b.body_id = post_body
    UNION ALL SELECT post_body, coalesce(in_roi, 'None'), 'pre' FROM edge JOIN neuron n ON n.body_id = pre_body LEFT JOIN best b ON b.body_id = pre_body) GROUP BY ALL""")
def e15_connection_categories(t: Tables) -> DataFrame:
    counts = A.body_counts(t.synapse)
    return A.connection_categories(t.edges, A.body_roi_counts(t.synapse), counts.where(C.neuron_by_counts(F.col("pre"), F.col("post"))))


_CENTROID = """centroid AS (SELECT body_id, CAST(floor(sum(x) / count(*) + 0.5) AS BIGINT) AS x, CAST(floor(sum(y) / count(*) + 0.5) AS BIGINT) AS y, CAST(floor(sum(z) / count(*) + 0.5) AS BIGINT) AS z
    FROM (SELECT DISTINCT body_id, x, y, z FROM synapse) GROUP BY body_id)"""


@query(f", {_CENTROID} SELECT * FROM centroid")
def e16_centroids(t: Tables) -> DataFrame:
    return A.centroid(t.synapse)


_VERTEX = """place AS (SELECT pre_body, post_body, x, y, z, max(a) AS a, max(b) AS b FROM (
        SELECT pre_body, post_body, pre_x AS x, pre_y AS y, pre_z AS z, 1 AS a, 0 AS b FROM edge UNION ALL SELECT pre_body, post_body, post_x, post_y, post_z, 0, 1 FROM edge) GROUP BY 1, 2, 3, 4, 5),
    vertex AS (SELECT pre_body, post_body, CAST(sum(a) AS BIGINT) AS pre, CAST(sum(b) AS BIGINT) AS post, CAST(floor(sum(x) / sum(a + b) + 0.5) AS BIGINT) AS x,
        CAST(floor(sum(y) / sum(a + b) + 0.5) AS BIGINT) AS y, CAST(floor(sum(z) / sum(a + b) + 0.5) AS BIGINT) AS z FROM place GROUP BY 1, 2)"""


@query(f", {_VERTEX} SELECT * FROM vertex WHERE pre + post > 2")
def e17_connection_vertices(t: Tables) -> DataFrame:
    return A.connection_vertices(t.edges, 2)


def _two_maps(t: Tables) -> DataFrame:
    """Region counts of bodies and of the part of their synapses with a confidence over one half."""
    all_, some = (A.as_roi_info(A.body_roi_counts(s), ["body_id"]) for s in (t.synapse, t.synapse.where("confidence > 0.5")))
    return all_.join(some.withColumnRenamed("roi_info", "part"), "body_id")


def _long(rows: DataFrame, c: str) -> DataFrame:
    return rows.select("body_id", F.explode(c).alias("roi", "v")).select("body_id", "roi", "v.pre", "v.post")


_PART = """part_roi AS (SELECT body_id, roi, count(*) FILTER (type = 'pre') AS pre, count(*) FILTER (type = 'post') AS post FROM syn_roi WHERE confidence > 0.5 GROUP BY 1, 2),
    both_ AS (SELECT body_id, roi, a.pre AS p, a.post AS q, coalesce(b.pre, 0) AS r, coalesce(b.post, 0) AS s FROM body_roi a LEFT JOIN part_roi b USING (body_id, roi) WHERE body_id IN (SELECT body_id FROM part_roi))"""


@query(f", {_PART} SELECT body_id, roi, p + r AS pre, q + s AS post FROM both_")
def e19_roi_merge(t: Tables) -> DataFrame:
    return _long(_two_maps(t).withColumn("m", C.roi_merge(F.col("roi_info"), F.col("part"))), "m")


@query(f", {_PART} SELECT body_id, roi, p - r AS pre, q - s AS post FROM both_ WHERE p > r OR q > s")
def e20_roi_subtract(t: Tables) -> DataFrame:
    return _long(_two_maps(t).withColumn("m", C.roi_subtract(F.col("roi_info"), F.col("part"))), "m")


@query("""SELECT b.body_id, coalesce(m.pre, 0) AS pre, coalesce(m.post, 0) AS post FROM synapse s JOIN body_roi b ON b.body_id = s.body_id AND b.roi = s.super_roi
    LEFT JOIN LATERAL (SELECT CASE WHEN s.type = 'pre' THEN b.pre - 1 ELSE b.pre END AS pre, CASE WHEN s.type = 'post' THEN b.post - 1 ELSE b.post END AS post) m ON true""")
def e21_roi_remove_synapse(t: Tables) -> DataFrame:
    """For every synapse, its body's counts in its super region without it."""
    info = A.as_roi_info(A.body_roi_counts(t.synapse), ["body_id"])
    rows = t.synapse.join(info, "body_id").withColumn("m", F.try_element_at(C.roi_remove(F.col("roi_info"), F.col("rois"), F.col("type")), F.col("super_roi")))
    rows = rows.select("body_id", F.inline(F.array("m")))  # the map is made once, not for each count
    return rows.select("body_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("pre", "post")))


@query("""SELECT CAST(p_partkey % 1000 AS BIGINT) AS body_id, min_by(p_name, p_partkey) AS name, min_by(p_type, p_partkey) AS type, min_by(p_brand, p_partkey) AS status, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY p_partkey % 1000""")
def e22_merge_properties(t: Tables) -> DataFrame:
    merges = t.body.select((F.col("body_id") % 1000).alias("target"), "body_id", F.col("body_id").alias("position"))
    return A.merge_properties(t.body, merges).select("body_id", "name", "type", "status", "size")


@query("""SELECT body_id, count(*) AS nodes, count(*) FILTER (parent_row = -1) AS roots, max(coalesce(c, 0) + CASE WHEN parent_row = -1 THEN 0 ELSE 1 END) AS max_degree
    FROM skel LEFT JOIN (SELECT body_id, parent_row AS row_no, count(*) AS c FROM skel WHERE parent_row <> -1 GROUP BY 1, 2) USING (body_id, row_no) GROUP BY body_id""")
def e24_skeleton_stats(t: Tables) -> DataFrame:
    return A.skeleton_stats(t.skel_node)


# Predicates and names


@query("SELECT body_id, pre >= 2 OR post >= 10 AS by_counts, pre >= 2 OR post >= 10 OR p_brand IS NOT NULL OR p_name IS NOT NULL AS by_evidence FROM body_n JOIN part ON p_partkey = body_id")
def d10_neuron_flags(t: Tables) -> DataFrame:
    rows = A.body_counts(t.synapse).join(t.body, "body_id")
    return rows.select("body_id", C.neuron_by_counts(F.col("pre"), F.col("post")).alias("by_counts"), C.neuron_by_evidence(F.col("pre"), F.col("post"), ("status", "name")).alias("by_evidence"))


@query("SELECT b.body_id FROM body_n b JOIN body_roi r USING (body_id) WHERE b.pre + b.post > 20 AND r.roi = 'EUROPE' AND r.pre + r.post > 5")
def d12_bodies_in_roi(t: Tables) -> DataFrame:
    return G.bodies_in_roi(A.body_counts(t.synapse), A.body_roi_counts(t.synapse), "EUROPE", 5, 20)


@query("SELECT syn_id, super_roi = 'ASIA' OR coalesce(sub1_roi, '') = 'ASIA' AS in_asia, confidence > 0.8 AS high FROM synapse")
def d16_synapse_predicates(t: Tables) -> DataFrame:
    return t.synapse.select("syn_id", F.array_contains("rois", "ASIA").alias("in_asia"), C.is_high(F.col("confidence"), 0.8).alias("high"))


@query("SELECT syn_id, CASE WHEN sub1_roi IS NULL OR sub1_roi = super_roi THEN super_roi ELSE concat(super_roi, '|', sub1_roi) END AS rois FROM synapse")
def d05_roi_lists(t: Tables) -> DataFrame:
    return t.synapse.select("syn_id", F.array_join("rois", "|").alias("rois"))


_NAME = """coalesce(string_agg(roi, '.' ORDER BY roi) FILTER ({0} AND m.post * 1.0 / nullif(b.post, 0) > {1}), 'none') || '-' || coalesce(string_agg(roi, '.' ORDER BY roi) FILTER ({0} AND m.pre * 1.0 / nullif(b.pre, 0) > {1}), 'none')"""


def _named(t: Tables) -> DataFrame:
    return A.body_counts(t.synapse).join(A.as_roi_info(A.body_roi_counts(t.synapse), ["body_id"]), "body_id")


@query(f"SELECT b.body_id, {_NAME.format('roi IN (SELECT r_name FROM region)', 0.1)} AS name FROM body_n b JOIN body_roi m USING (body_id) GROUP BY b.body_id")
def i04_region_names(t: Tables) -> DataFrame:
    supers = F.array(*(F.lit(r.r_name) for r in t.read("region").select("r_name").collect()))
    return _named(t).select("body_id", C.region_name(F.col("roi_info"), F.col("pre"), F.col("post"), 0.1, supers).alias("name"))


@query(f"SELECT b.body_id, {_NAME.format('roi NOT IN (SELECT r_name FROM region)', 0.05)} AS name FROM body_n b JOIN body_roi m USING (body_id) GROUP BY b.body_id")
def i05_sub_region_names(t: Tables) -> DataFrame:
    supers = F.array(*(F.lit(r.r_name) for r in t.read("region").select("r_name").collect()))
    return _named(t).select("body_id", C.region_name(F.col("roi_info"), F.col("pre"), F.col("post"), 0.05, F.array(*map(F.lit, _axis(t))), supers).alias("name"))


@query(f"SELECT b.body_id, {_NAME.format('roi IN (SELECT r_name FROM region)', 0.2)} AS name FROM body_n b JOIN body_roi m USING (body_id) GROUP BY b.body_id")
def m04_names_in_sql(t: Tables) -> DataFrame:
    C.register(t.spark)
    supers = F.array(*(F.lit(r.r_name) for r in t.read("region").select("r_name").collect()))
    rows = _named(t).withColumn("supers", supers)
    return rows.selectExpr("body_id", "roi_info_as_name(roi_info, pre, post, 0.2D, supers) AS name")


@query("SELECT body_id, string_agg(concat(roi, '=', pre, '/', post), ',' ORDER BY roi) AS text FROM body_roi GROUP BY body_id")
def i08_roi_info_round_trip(t: Tables) -> DataFrame:
    """Region maps through their JSON text and back."""
    rows = A.as_roi_info(A.body_roi_counts(t.synapse), ["body_id"]).withColumn("m", C.roi_from_json(C.roi_json(F.col("roi_info"))))
    part = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"]["pre"].cast("string"), F.lit("/"), e["value"]["post"].cast("string")))
    return rows.select("body_id", F.array_join(part, ",").alias("text"))


@query("SELECT concat('brain:', pre_body, ':', post_body) AS id, CAST(post_body AS VARCHAR) AS last FROM conn")
def i09_composite_ids(t: Tables) -> DataFrame:
    rows = A.connections(t.edges).select(H.connection_id("brain").alias("id"))
    return rows.select("id", C.id_part(F.col("id"), 2).alias("last"))


@query("SELECT DISTINCT super_roi, sub1_roi, status_, cropped FROM (SELECT super_roi, coalesce(sub1_roi, '') AS sub1_roi, CASE WHEN y = 1 THEN 'Traced' WHEN y = 2 THEN 'Orphan' WHEN y = 3 THEN 'Assign' ELSE 'other' END AS status_, CASE WHEN y = 1 THEN true END AS cropped FROM synapse)")
def d07_status(t: Tables) -> DataFrame:
    label = F.when(F.col("y") == 1, "Leaves").when(F.col("y") == 2, "Orphan hotknife").when(F.col("y") == 3, "0.5assign").otherwise("other")
    return t.synapse.select("super_roi", F.coalesce("sub1_roi", F.lit("")).alias("sub1_roi"), C.status_of(label).alias("status_"), C.cropped_of(label).alias("cropped")).distinct()


# Ranking


@query(f", {_BEST} SELECT body_id, out_roi, in_roi FROM best")
def f01_top_rois(t: Tables) -> DataFrame:
    by_roi = A.body_roi_counts(t.synapse)
    return R.top_roi(by_roi, "pre").select("body_id", F.col("roi").alias("out_roi")).join(R.top_roi(by_roi, "post").select("body_id", F.col("roi").alias("in_roi")), "body_id")


@query(f", {_TOP} SELECT body_id, partner, is_out, weight, CAST(rank AS INTEGER) AS rank FROM top WHERE rank <= 5")
def f02_top_partners(t: Tables) -> DataFrame:
    return R.top_partners(A.connections(t.edges), 5)


@query(f""", {_CENTROID}, d AS (SELECT s.body_id, s.x, s.y, s.z, row_number() OVER (PARTITION BY s.body_id ORDER BY (s.x - c.x) ** 2 + (s.y - c.y) ** 2 + (s.z - c.z) ** 2, s.x, s.y, s.z) AS rn FROM synapse s JOIN centroid c USING (body_id))
    SELECT p_partkey AS body_id, coalesce(x, 0) AS x, coalesce(y, 0) AS y, coalesce(z, 0) AS z FROM part LEFT JOIN (SELECT * FROM d WHERE rn = 1) ON body_id = p_partkey""")
def f03_central_synapses(t: Tables) -> DataFrame:
    return R.central_synapse(t.synapse, A.centroid(t.synapse), t.body)


@query(f""", {_CENTROID}, d AS (SELECT s.body_id, s.row_no, (s.x - c.x) ** 2 + (s.y - c.y) ** 2 + (s.z - c.z) ** 2 AS dd FROM skel s JOIN centroid c USING (body_id))
    SELECT body_id, CAST(min_by(row_no, {{'a': dd, 'b': row_no}}) AS BIGINT) AS row_no FROM d GROUP BY body_id""")
def f04_nearest_skel_nodes(t: Tables) -> DataFrame:
    points = A.centroid(t.synapse).withColumn("point_id", F.col("body_id"))
    return R.nearest_skel_node(t.skel_node, points).select("body_id", "row_no")


@query("SELECT s.syn_id, s.body_id, CAST(min_by(k.row_no, {'a': (s.x - k.x) ** 2 + (s.y - k.y) ** 2 + (s.z - k.z) ** 2, 'b': k.row_no}) AS BIGINT) AS row_no FROM synapse s JOIN skel k USING (body_id) GROUP BY 1, 2")
def f04_nearest_nodes_of_synapses(t: Tables) -> DataFrame:
    """Every synapse of a body with a skeleton."""
    return R.nearest_skel_node(t.skel_node, t.synapse.withColumnRenamed("syn_id", "point_id")).select(F.col("point_id").alias("syn_id"), "body_id", "row_no")


@query("SELECT l_orderkey, l_linenumber, min_by(l_partkey, {'a': l_partkey, 'b': l_suppkey}) AS l_partkey FROM lineitem GROUP BY 1, 2")
def f05_keep_first(t: Tables) -> DataFrame:
    return R.keep_first(t.read("lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT syn_id, 99000000000 + row_number() OVER (ORDER BY x, y, z, type) - 1 AS new_id FROM synapse")
def f06_synapse_ids(t: Tables) -> DataFrame:
    return R.numbered(t.synapse.select("syn_id", "x", "y", "z", "type"), ["x", "y", "z", "type"], 99_000_000_000, "new_id").select("syn_id", "new_id")


@query("SELECT pre_body, post_body, weight, weight_hp FROM conn ORDER BY weight DESC, weight_hp DESC, pre_body, post_body LIMIT 100")
def g05_top_connections(t: Tables) -> DataFrame:
    return R.top_connections(A.connections(t.edges, 0.2, 0.8), 100)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def v06_duplicate_keys(t: Tables) -> DataFrame:
    return V.duplicates(t.read("lineitem"), ["l_orderkey", "l_linenumber"])


# Joins and sets


@query("SELECT pre_id, post_id, pre_body, post_body, pre_conf, post_conf FROM edge")
def h01_resolved_edges(t: Tables) -> DataFrame:
    return H.resolve_edges(t.syn_edge, t.synapse).select("pre_id", "post_id", "pre_body", "post_body", "pre_conf", "post_conf")


_SETS = "sets AS (SELECT concat(pre_body, '_', post_body, '_pre') AS set_id, pre_body AS body_id, pre_id AS syn_id FROM edge UNION ALL SELECT concat(post_body, '_', pre_body, '_post'), post_body, post_id FROM edge)"


@query(f", {_SETS} SELECT DISTINCT set_id FROM sets")
def h03_synapse_sets(t: Tables) -> DataFrame:
    return H.synapse_sets(t.edges)


@query(f", {_SETS} SELECT DISTINCT set_id, syn_id FROM sets")
def h03_synapse_set_members(t: Tables) -> DataFrame:
    return H.synapse_set_members(t.edges)


@query("SELECT DISTINCT concat(pre_body, '_', post_body, '_pre') AS from_set, concat(post_body, '_', pre_body, '_post') AS to_set FROM edge")
def h03_synapse_set_links(t: Tables) -> DataFrame:
    return H.synapse_set_links(t.edges)


@query(f", {_SETS} SELECT DISTINCT body_id, set_id FROM sets")
def h03_body_synapse_sets(t: Tables) -> DataFrame:
    return H.body_synapse_sets(t.edges)


@query("""SELECT p_partkey AS body_id, CAST(p_size AS BIGINT) AS size, coalesce(a.n, 0) AS downstream, coalesce(b.n, 0) AS upstream FROM part
    LEFT JOIN (SELECT pre_body, count(*) AS n FROM edge GROUP BY 1) a ON a.pre_body = p_partkey LEFT JOIN (SELECT post_body, count(*) AS n FROM edge GROUP BY 1) b ON b.post_body = p_partkey""")
def h05_enriched_bodies(t: Tables) -> DataFrame:
    return H.enrich_bodies(t.body, A.partner_counts(t.edges), t.body.select("body_id", "size")).select("body_id", "size", "downstream", "upstream")


@query("""SELECT syn_id, name FROM synapse LEFT JOIN (SELECT z, y, min(x) AS x0, (min(x) + max(x)) // 2 AS x1, max(super_roi) AS name FROM synapse GROUP BY z, y) r
    ON r.z = synapse.z AND r.y = synapse.y AND x BETWEEN x0 AND x1""")
def h06_points_to_regions(t: Tables) -> DataFrame:
    runs = t.synapse.groupBy("z", "y").agg(F.min("x").alias("x0"), F.floor((F.min("x") + F.max("x")) / 2).cast("long").alias("x1"), F.max("super_roi").alias("name"))
    return H.map_points(t.synapse.select("syn_id", "x", "y", "z"), runs, "name").select("syn_id", "name")


@query("""SELECT syn_id, name FROM synapse LEFT JOIN (SELECT z >> 5 AS zb, y >> 5 AS yb, min(x) >> 5 AS x0, (min(x) >> 5) + ((max(x) >> 5) - (min(x) >> 5)) * 2 // 3 AS x1, max(sub1_roi) AS name FROM synapse GROUP BY 1, 2) r
    ON r.zb = z >> 5 AND r.yb = y >> 5 AND x >> 5 BETWEEN x0 AND x1""")
def h06_points_to_regions_by_blocks(t: Tables) -> DataFrame:
    """Runs in blocks of 32 voxels that go over two thirds of the axis."""
    low, high = F.shiftright(F.min("x"), 5), F.shiftright(F.max("x"), 5)
    runs = t.synapse.groupBy(F.shiftright("z", 5).alias("z"), F.shiftright("y", 5).alias("y")).agg(low.alias("x0"), (low + F.floor((high - low) * 2 / 3)).alias("x1"), F.max("sub1_roi").alias("name"))
    return H.map_points(t.synapse.select("syn_id", "x", "y", "z"), runs, "name", scale=5).select("syn_id", "name")


@query("SELECT p_partkey AS body_id, coalesce(size, -1) AS size FROM part LEFT JOIN (SELECT body_id AS k, pre AS size FROM body_n WHERE pre > 0) ON k = p_partkey")
def h08_body_sizes(t: Tables) -> DataFrame:
    return H.body_sizes(t.body, A.body_counts(t.synapse).where("pre > 0").select("body_id", F.col("pre").alias("size")))


@query(f", {_NEAR} SELECT body_id, partner, is_out, weight FROM near")
def h09_neighbors(t: Tables) -> DataFrame:
    return R.neighbors(A.connections(t.edges))


@query("SELECT a.pre_body, a.post_body, a.weight, a.weight_hp FROM conn a JOIN conn b ON a.pre_body = b.post_body AND a.post_body = b.pre_body")
def h10_reciprocal_connections(t: Tables) -> DataFrame:
    conns = A.connections(t.edges, 0.2, 0.8)
    return H.connection_between(conns, conns.select(F.col("post_body").alias("pre_body"), F.col("pre_body").alias("post_body")))


@query("SELECT pre_id AS syn_id, pre_body, post_body FROM edge UNION SELECT post_id, pre_body, post_body FROM edge")
def h11_synapse_connections(t: Tables) -> DataFrame:
    return H.synapse_connections(t.edges)


@query("SELECT DISTINCT pre_body, post_body, syn_id, side FROM (SELECT pre_body, post_body, pre_id AS syn_id, 'pre' AS side FROM edge WHERE post_conf > 0.5 UNION ALL SELECT pre_body, post_body, post_id, 'post' FROM edge WHERE post_conf > 0.5)")
def h12_pruned_connection_synapses(t: Tables) -> DataFrame:
    """Connection synapses that keep a link when links to doubtful posts go."""
    return H.prune_unlinked(A.connection_synapses(t.edges), t.edges.where("post_conf > 0.5")).select("pre_body", "post_body", "syn_id", "side")


@query("SELECT syn_id FROM synapse WHERE body_id NOT IN (SELECT body_id FROM body_n WHERE pre >= 2)")
def h13_orphans(t: Tables) -> DataFrame:
    """Synapses that are orphans when bodies with fewer than two pres own nothing."""
    kept = A.body_counts(t.synapse).where("pre >= 2").select("body_id")
    return H.orphans(t.synapse.drop("body_id"), t.synapse.select("syn_id", "body_id").join(kept, "body_id", "left_semi").select("syn_id")).select("syn_id")


@query("SELECT pre_body AS a, post_body AS b FROM conn UNION SELECT post_body, pre_body FROM conn")
def h17_pairs_once(t: Tables) -> DataFrame:
    return H.all_pairs_once(A.connections(t.edges))


# Graphs and trees


@query(f""", {_VERTEX}, own AS (SELECT pre_body AS body_id, *, concat(pre_body, '_', post_body) AS v FROM vertex WHERE pre + post > 3 UNION ALL SELECT post_body, *, concat(pre_body, '_', post_body) FROM vertex WHERE pre + post > 3 AND pre_body <> post_body)
    SELECT a.body_id, a.v AS source, b.v AS target, CAST(floor(sqrt(CAST((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 AS DOUBLE)) + 0.5) AS BIGINT) AS distance FROM own a JOIN own b ON a.body_id = b.body_id AND a.v < b.v""")
def j04_line_graphs(t: Tables) -> DataFrame:
    """The line graphs of all bodies."""
    return G.line_graph(t.edges, t.body, 3)[1]


@query(f""", {_VERTEX}, own AS (
        SELECT pre_body AS body_id, x, y, z, concat(pre_body, '_', post_body) AS v FROM vertex WHERE pre + post > 2 UNION
        SELECT post_body, x, y, z, concat(pre_body, '_', post_body) FROM vertex WHERE pre + post > 2),
    spot AS (SELECT o.body_id, o.v, o.x, o.y, o.z, min_by(k.row_no, {{'a': (o.x - k.x) ** 2 + (o.y - k.y) ** 2 + (o.z - k.z) ** 2, 'b': k.row_no}}) AS row_no FROM own o LEFT JOIN skel k USING (body_id) WHERE o.body_id IN (SELECT p_partkey FROM part) GROUP BY ALL),
    link AS (SELECT c.body_id, c.row_no, c.parent_row, sqrt(CAST((c.x - p.x) ** 2 + (c.y - p.y) ** 2 + (c.z - p.z) ** 2 AS DOUBLE)) AS len FROM skel c JOIN skel p ON p.body_id = c.body_id AND p.row_no = c.parent_row),
    up AS (
        SELECT DISTINCT body_id, row_no, row_no AS anc, 0.0::DOUBLE AS len, 0 AS hops FROM spot WHERE row_no IS NOT NULL
        UNION ALL SELECT u.body_id, u.row_no, l.parent_row, u.len + l.len, u.hops + 1 FROM up u JOIN link l ON l.body_id = u.body_id AND l.row_no = u.anc),
    far AS (SELECT a.body_id, a.v AS source, b.v AS target, a.row_no AS p, b.row_no AS q, CAST(floor(sqrt(CAST((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 AS DOUBLE)) + 0.5) AS BIGINT) AS distance FROM spot a JOIN spot b ON a.body_id = b.body_id AND a.v < b.v),
    cable AS (SELECT s.body_id, s.row_no AS p, e.row_no AS q, CAST(floor(min_by(s.len + e.len, s.hops + e.hops) + 0.5) AS BIGINT) AS cable_distance FROM up s JOIN up e ON e.body_id = s.body_id AND e.anc = s.anc GROUP BY 1, 2, 3)
    SELECT body_id, source, target, distance, cable_distance FROM far LEFT JOIN cable USING (body_id, p, q)""")
def j04_line_graphs_with_cable(t: Tables) -> DataFrame:
    """The line graphs of all bodies, with distances along their skeletons where they have one."""
    return G.line_graph(t.edges, t.body, 2, t.skel_node)[1].select("body_id", "source", "target", "distance", "cable_distance")


def j01_shortest_paths(t: Tables) -> DataFrame:
    """All shortest paths from the strongest output body to the strongest input body of every region; the search
    covers the whole graph from each source."""
    by_roi = A.body_roi_counts(t.synapse)
    best = lambda c, to: by_roi.groupBy("roi").agg(F.min_by("body_id", F.struct((-F.col(c)).alias("a"), "body_id")).alias(to))
    pairs = best("pre", "source").join(best("post", "target"), "roi").select("source", "target")
    rows = G.shortest_paths(A.connections(t.edges), pairs)
    return rows.select("source", "target", "distance", F.size("path").alias("nodes"), F.array_join(F.transform("path", lambda b: b.cast("string")), ">").alias("path"))


query("""
    , src AS (SELECT DISTINCT s AS source FROM (SELECT min_by(body_id, {'a': -pre, 'b': body_id}) AS s FROM body_roi GROUP BY roi)),
    pairs AS (SELECT DISTINCT source, target FROM (SELECT min_by(body_id, {'a': -pre, 'b': body_id}) AS source, min_by(body_id, {'a': -post, 'b': body_id}) AS target FROM body_roi GROUP BY roi) WHERE source <> target),
    arc AS (SELECT pre_body AS a, post_body AS b, min(weight) AS w FROM conn GROUP BY 1, 2),
    best(source, node, d) USING KEY (source, node) AS (
        SELECT source, source, 0::BIGINT FROM src
        UNION SELECT f.source, arc.b, CAST(min(f.d + arc.w) AS BIGINT) FROM best f JOIN arc ON arc.a = f.node LEFT JOIN recurring.best k ON k.source = f.source AND k.node = arc.b
        WHERE k.d IS NULL OR f.d + arc.w < k.d GROUP BY 1, 2),
    back AS (
        SELECT p.source, p.target, b.d AS distance, p.target AS node, b.d AS rest, CAST(p.target AS VARCHAR) AS path, 1 AS nodes FROM pairs p JOIN best b ON b.source = p.source AND b.node = p.target
        UNION ALL SELECT k.source, k.target, k.distance, arc.a, b.d, concat(arc.a, '>', k.path), k.nodes + 1 FROM back k JOIN arc ON arc.b = k.node JOIN best b ON b.source = k.source AND b.node = arc.a AND b.d + arc.w = k.rest)
    SELECT source, target, CAST(distance AS DOUBLE) AS distance, nodes, path FROM back WHERE node = source""")(j01_shortest_paths)


@query("""
    , link AS (SELECT c.body_id, c.row_no, c.parent_row, sqrt(CAST((c.x - p.x) ** 2 + (c.y - p.y) ** 2 + (c.z - p.z) ** 2 AS DOUBLE)) AS len FROM skel c JOIN skel p ON p.body_id = c.body_id AND p.row_no = c.parent_row),
    ends AS (SELECT body_id, max(row_no) AS b, max(row_no) // 2 + 1 AS a FROM skel GROUP BY body_id),
    up AS (
        SELECT body_id, a AS row_no, a AS anc, 0.0::DOUBLE AS len, 0 AS hops FROM ends UNION SELECT body_id, b, b, 0.0::DOUBLE, 0 FROM ends
        UNION ALL SELECT u.body_id, u.row_no, l.parent_row, u.len + l.len, u.hops + 1 FROM up u JOIN link l ON l.body_id = u.body_id AND l.row_no = u.anc)
    SELECT e.body_id, e.a, e.b, CAST(floor(min_by(p.len + q.len, p.hops + q.hops) + 0.5) AS BIGINT) AS distance FROM ends e
    JOIN up p ON p.body_id = e.body_id AND p.row_no = e.a JOIN up q ON q.body_id = e.body_id AND q.row_no = e.b AND q.anc = p.anc GROUP BY 1, 2, 3""")
def j02_cable_distances(t: Tables) -> DataFrame:
    """Between the last row of every skeleton and the row after its half."""
    last = t.skel_node.groupBy("body_id").agg(F.max("row_no").alias("b"))
    return G.cable_distance(t.skel_node, last.select("body_id", (F.floor(F.col("b") / 2) + 1).alias("a"), "b"))


@query("SELECT c.body_id, c.parent_row, c.row_no FROM skel c JOIN skel p ON p.body_id = c.body_id AND p.row_no = c.parent_row")
def j06_skeleton_links(t: Tables) -> DataFrame:
    return G.skeleton_links(t.skel_node)


# Edits


def _edit_log(t: Tables) -> DataFrame:
    """The event stream as edits; the synapse is taken from the event's number."""
    e = t.read("events")
    orders = t.read("orders").agg(F.count("*").alias("n"))  # one row
    kinds = {"signup": "add_neuron", "view": "orphan_synapse", "click": "update_properties", "purchase": "add_synapse_to_segment", "error": "delete_synapse"}
    kind = F.coalesce(*(F.when(F.col("event_type") == k, v) for k, v in kinds.items()))
    e = e.crossJoin(F.broadcast(orders)).withColumn("kind", kind)
    syn = ((F.col("event_id") * 7) % F.col("n")) * 1000 + F.col("event_id") % 3 + 1
    empty = lambda kind_: F.array().cast(kind_)
    return e.select(
        F.col("event_id").alias("seq"), "ts", F.lit(None).cast("string").alias("mutation_key"), "kind", F.col("user_id").alias("body_id"), empty("array<bigint>").alias("bodies"),
        F.when(F.col("kind").isin("orphan_synapse", "add_synapse_to_segment", "delete_synapse"), syn).alias("syn_id"), F.lit(None).cast("long").alias("post_id"), *(F.lit(None).cast("long").alias(c) for c in "xyz"),
        F.lit(None).cast("string").alias("type"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("roi"), empty("array<bigint>").alias("synapses"),
        F.when(F.col("kind") == "update_properties", F.create_map(F.lit("status"), F.col("props"))).alias("props"), F.lit(None).cast("array<struct<row_no:int,type:int,x:bigint,y:bigint,z:bigint,radius:double,parent_row:int>>").alias("skeleton"),
    )


def _base(t: Tables) -> dict[str, DataFrame]:
    s = t.synapse
    return {"synapse": s.select("syn_id", "x", "y", "z", "type", "confidence", "rois"), "syn_edge": t.syn_edge, "membership": s.select("body_id", "syn_id"), "body": t.body}


def _at_rest(t: Tables) -> DataFrame:
    """Synapses with their bodies, written once."""
    return G.checkpointed(t.synapse.select("syn_id", "x", "y", "z", "type", "confidence", "rois", "body_id"))


def _stored(t: Tables, s: DataFrame | None = None) -> dict[str, DataFrame]:
    """The same as the base, from synapses at rest: a graph that edits read by key."""
    s = _at_rest(t) if s is None else s
    ends = lambda kind, name: s.where(F.col("type") == kind).select("x", F.col("syn_id").alias(name))
    return {"synapse": s.drop("body_id"), "syn_edge": ends("pre", "pre_id").join(ends("post", "post_id"), "x").drop("x"), "membership": s.select("body_id", "syn_id"), "body": t.body, "skel_node": t.skel_node}


def _log(rows: DataFrame) -> DataFrame:
    """rows as edits; columns that they lack are null."""
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(EDIT)))


def _after(t: Tables, *edits: DataFrame, s: DataFrame | None = None) -> dict[str, DataFrame]:
    return K.apply_edits(_stored(t, s), reduce(DataFrame.unionByName, map(_log, edits)))[0]


_EDITED = """, ev AS (SELECT event_id AS seq, user_id AS body_id, event_type AS kind, ((event_id * 7) % (SELECT count(*) FROM orders)) * 1000 + event_id % 3 + 1 AS syn_id, props FROM events),
    born AS (SELECT body_id, min(seq) AS at FROM ev WHERE kind = 'signup' GROUP BY 1),
    gone AS (SELECT syn_id, min(seq) AS at FROM ev WHERE kind = 'error' GROUP BY 1),
    own AS (SELECT syn_id, arg_max({'b': CASE WHEN kind = 'purchase' THEN body_id END}, seq) AS o FROM ev LEFT JOIN born USING (body_id)
        WHERE kind = 'view' OR kind = 'purchase' AND (body_id IN (SELECT p_partkey FROM part) OR coalesce(born.at < seq, false)) GROUP BY 1),
    live AS (SELECT s.syn_id, CASE WHEN own.syn_id IS NULL THEN s.body_id ELSE own.o.b END AS body_id, s.confidence, s.type FROM synapse s LEFT JOIN own USING (syn_id) WHERE s.syn_id NOT IN (SELECT syn_id FROM gone))"""


@query(f"""{_EDITED} SELECT a.body_id AS pre_body, b.body_id AS post_body, count(DISTINCT post_id) AS weight, count(DISTINCT post_id) FILTER (b.confidence > 0.8) AS weight_hp
    FROM edge JOIN live a ON a.syn_id = pre_id JOIN live b ON b.syn_id = post_id WHERE a.body_id IS NOT NULL AND b.body_id IS NOT NULL GROUP BY 1, 2""")
def k12_connections_after_edits(t: Tables) -> DataFrame:
    graph, _, _ = K.apply_edits(_stored(t), _edit_log(t))
    return derive(graph, 0.2, 0.8, with_regions=False)["connection"]


@query(f"""{_EDITED}, last AS (SELECT e.body_id, arg_max(props, seq) AS status FROM ev e LEFT JOIN born USING (body_id) WHERE kind = 'click' AND (e.body_id IN (SELECT p_partkey FROM part) OR coalesce(born.at < seq, false)) GROUP BY 1)
    SELECT body_id, coalesce(last.status, p_brand) AS status FROM (SELECT p_partkey AS body_id FROM part UNION SELECT body_id FROM born) LEFT JOIN part ON p_partkey = body_id LEFT JOIN last USING (body_id)""")
def k01_bodies_after_edits(t: Tables) -> DataFrame:
    graph, _, _ = K.apply_edits(_stored(t), _edit_log(t))
    return graph["body"].select("body_id", "status")


@query(f"SELECT p_partkey AS body_id, pre, post, coalesce(pre, 0) >= 2 OR coalesce(post, 0) >= 10 AS is_neuron, CASE WHEN pre >= 2 OR post >= 10 THEN name END AS cluster_name FROM part LEFT JOIN (SELECT b.body_id, b.pre, b.post, {_NAME.format('roi IN (SELECT super_roi FROM synapse)', 0.1)} AS name FROM body_n b JOIN body_roi m USING (body_id) GROUP BY ALL) ON body_id = p_partkey")
def k19_body_info(t: Tables) -> DataFrame:
    return derive(_base(t), threshold=10)["body_info"].select("body_id", "pre", "post", "is_neuron", "cluster_name")


@query("SELECT DISTINCT pre_body, post_body, syn_id FROM (SELECT pre_body, post_body, pre_id AS syn_id FROM edge UNION ALL SELECT pre_body, post_body, post_id FROM edge)")
def k18_connection_synapses_once(t: Tables) -> DataFrame:
    rows = A.connection_synapses(t.edges)
    return K.without_repeats(rows.unionByName(rows)).select("pre_body", "post_body", "syn_id")


@query("SELECT max(ts) AS last_edit FROM events")
def l03_freshness(t: Tables) -> DataFrame:
    return freshness(_edit_log(t))


def _sizes(graph: dict[str, DataFrame]) -> DataFrame:
    """Bodies with their attributes and how many synapses they own."""
    n = graph["membership"].groupBy("body_id").agg(F.count("*").alias("n"))
    return graph["body"].join(n, "body_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("""SELECT body_id, CASE WHEN body_id % 4 = 1 THEN NULL ELSE p_name END AS name, CASE body_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN concat('S', body_id) ELSE p_brand END AS status,
    body_id % 4 <> 1 OR coalesce(pre >= 2 OR post >= 10, false) AS is_neuron, (body_id % 4 <> 1 OR coalesce(pre >= 2 OR post >= 10, false)) AND pre + post > 0 AS has_cluster
    FROM (SELECT p_partkey AS body_id, p_name, p_brand FROM part) LEFT JOIN body_n USING (body_id)""")
def k03_properties_and_demotion(t: Tables) -> DataFrame:
    """set_properties with null, delete_property of all evidence, update_properties; bodies without evidence are no neurons."""
    b = t.body.select("body_id", F.col("body_id").alias("seq"))
    text = lambda v: F.lit(v).cast("string")
    clear = b.where("body_id % 4 = 0").withColumns({"kind": F.lit("set_properties"), "props": F.create_map(F.lit("status"), text(None))})
    drop = b.where("body_id % 4 = 1").withColumns({"kind": F.lit("delete_property"), "props": F.create_map(F.lit("status"), text(None), F.lit("name"), text(None))})
    put = b.where("body_id % 4 = 2").withColumns({"kind": F.lit("update_properties"), "props": F.create_map(F.lit("status"), F.concat(F.lit("S"), "body_id"), F.lit("name"), text(None))})
    info = derive(_after(t, clear, drop, put))["body_info"]
    return info.select("body_id", "name", "status", "is_neuron", F.col("cluster_name").isNotNull().alias("has_cluster"))


@query("""SELECT body_id, name, n FROM (
    SELECT p_partkey AS body_id, p_name AS name, (SELECT count(*) FROM synapse s WHERE s.body_id = p_partkey) AS n FROM part WHERE p_partkey % 10 <> 3
    UNION ALL SELECT 2000000000 + p_partkey, 'again', (SELECT count(*) FROM synapse s WHERE s.body_id = p_partkey AND syn_id % 2 = 1) FROM part WHERE p_partkey % 10 = 3 AND EXISTS (SELECT 1 FROM synapse s WHERE s.body_id = p_partkey AND syn_id % 2 = 1))""")
def k05_bodies_deleted_and_added(t: Tables) -> DataFrame:
    """Every tenth body goes; new bodies take half of the synapses that this leaves without owner."""
    s = _at_rest(t)
    gone = t.body.where("body_id % 10 = 3").select("body_id", F.col("body_id").alias("seq"), F.lit("delete_neuron").alias("kind"))
    free = s.where("body_id % 10 = 3 AND syn_id % 2 = 1").groupBy("body_id").agg(F.collect_list("syn_id").alias("synapses"))
    new = free.select((F.col("body_id") + 2_000_000_000).alias("body_id"), (F.col("body_id") + 2_000_000_000).alias("seq"), F.lit("add_neuron").alias("kind"), "synapses", F.create_map(F.lit("name"), F.lit("again")).alias("props"))
    return _sizes(_after(t, gone, new, s=s)).select("body_id", "name", "n")


@query("""SELECT body_id, count(*) AS n, max(row_no) AS last FROM skel WHERE NOT (body_id % 3 = 0 AND body_id IN (SELECT p_partkey FROM part)) GROUP BY 1
    UNION ALL SELECT p_partkey, 1, 7 FROM part WHERE p_partkey NOT IN (SELECT body_id FROM skel)""")
def k06_skeletons_added_and_deleted(t: Tables) -> DataFrame:
    """Every third skeleton of a body goes; bodies without one get one, and an addition to others is rejected."""
    bodies = t.body.select("body_id", F.col("body_id").alias("seq"))
    had = t.skel_node.select("body_id").distinct()
    gone = bodies.where("body_id % 3 = 0").join(had, "body_id", "left_semi").withColumn("kind", F.lit("delete_skeleton"))
    node = F.array(F.struct(F.lit(7).alias("row_no"), F.lit(0).alias("type"), *(F.lit(1).alias(c) for c in "xyz"), F.lit(1.0).alias("radius"), F.lit(-1).alias("parent_row")))
    new = bodies.where("body_id % 3 <> 0").unionByName(bodies.where("body_id % 3 = 0").join(had, "body_id", "left_anti")).withColumns({"kind": F.lit("add_skeleton"), "skeleton": node})
    return _after(t, gone, new)["skel_node"].groupBy("body_id").agg(F.count("*").alias("n"), F.max("row_no").cast("long").alias("last"))


@query("""SELECT body_id, roi, count(*) FILTER (type = 'pre') AS pre, count(*) FILTER (type = 'post') AS post FROM (
    SELECT r.body_id, r.type, r.roi FROM syn_roi r JOIN synapse s USING (syn_id) WHERE NOT (syn_id % 7 = 0 AND r.roi = s.super_roi) UNION ALL SELECT body_id, type, 'EXTRA' FROM synapse WHERE syn_id % 5 = 0) GROUP BY 1, 2""")
def k08_regions_added_and_removed(t: Tables) -> DataFrame:
    s = _at_rest(t)
    syn = s.select("syn_id", F.get("rois", F.lit(0)).alias("super_roi"))  # the first of a synapse's regions
    put = syn.where("syn_id % 5 = 0").select("syn_id", F.col("syn_id").alias("seq"), F.lit("add_roi").alias("kind"), F.lit("EXTRA").alias("roi"))
    drop = syn.where("syn_id % 7 = 0").select("syn_id", (F.col("syn_id") + 10**12).alias("seq"), F.lit("remove_roi").alias("kind"), F.col("super_roi").alias("roi"))
    graph = _after(t, put, drop, s=s)
    return A.body_roi_counts(H.with_bodies(graph["synapse"], graph["membership"]))


@query("""SELECT pre_body, post_body, count(DISTINCT post_id) AS weight, count(DISTINCT post_id) FILTER (post_conf > 0.8) AS weight_hp, count(DISTINCT post_id) FILTER (roi = 'NEW') AS new FROM (
    SELECT pre_body, post_body, post_id, post_conf, NULL AS roi FROM edge UNION ALL SELECT body_id, body_id, x * 1000 + 999, 0.95, 'NEW' FROM synapse WHERE type = 'pre' AND x % 3 = 0) GROUP BY 1, 2""")
def k10_synapses_and_links_added(t: Tables) -> DataFrame:
    """Orders get a new pre and post, a link between them and the body of their first pre as owner; the post's region comes
    along."""
    s = _at_rest(t)
    at = s.where("type = 'pre' AND x % 3 = 0").select("x", "body_id")
    one = lambda step, kind, **c: at.select((F.col("x") * 10 + step).alias("seq"), F.lit(kind).alias("kind"), *(v.alias(k) for k, v in c.items()))
    pre, post, zero = F.col("x") * 1000 + 998, F.col("x") * 1000 + 999, F.lit(0)
    graph = _after(
        t, one(0, "add_synapse", syn_id=pre, x=F.col("x"), y=F.lit(998), z=zero, type=F.lit("pre"), confidence=F.lit(0.95)), one(1, "add_synapse", syn_id=post, x=F.col("x"), y=F.lit(999), z=zero, type=F.lit("post"), confidence=F.lit(0.95), rois=F.array(F.lit("NEW"))),
        one(2, "add_link", syn_id=pre, post_id=post), one(3, "add_synapse_to_segment", syn_id=pre, body_id=F.col("body_id")), one(4, "add_synapse_to_segment", syn_id=post, body_id=F.col("body_id")),
        s=s,
    )
    edges = H.resolve_edges(graph["syn_edge"], H.with_bodies(graph["synapse"], graph["membership"]))
    new = edges.where(F.array_contains("post_rois", "NEW")).groupBy("pre_body", "post_body").agg(F.countDistinct("post_id").alias("new"))
    return A.connections(edges, 0.2, 0.8).join(new, ["pre_body", "post_body"], "left").select("pre_body", "post_body", "weight", "weight_hp", F.coalesce("new", F.lit(0)).alias("new"))


@query("""SELECT CASE WHEN p_partkey % 2 = 0 AND p_partkey - 1 IN (SELECT p_partkey FROM part) THEN p_partkey - 1 ELSE p_partkey END AS body_id, arg_min(p_name, p_partkey) AS name, CAST(sum(p_size) AS BIGINT) AS size, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n
    FROM part LEFT JOIN (SELECT body_id, count(*) AS n FROM synapse GROUP BY 1) ON body_id = p_partkey GROUP BY 1""")
def k15_merged_bodies(t: Tables) -> DataFrame:
    """Every odd body takes in the one after it."""
    odd, even = t.body.where("body_id % 2 = 1").select("body_id"), t.body.where("body_id % 2 = 0").select((F.col("body_id") - 1).alias("body_id"))
    pairs = odd.join(even, "body_id").select(F.col("body_id").alias("seq"), F.lit("merge").alias("kind"), F.array("body_id", F.col("body_id") + 1).alias("bodies"))
    return _sizes(_after(t, pairs)).select("body_id", "name", "size", "n")


@query("""SELECT body_id, name, n FROM (
    SELECT p_partkey AS body_id, p_name AS name, (SELECT count(*) FROM synapse s WHERE s.body_id = p_partkey AND NOT (p_partkey % 7 = 0 AND syn_id % 2 = 0)) AS n FROM part
    UNION ALL SELECT 1000000000 + p_partkey, p_name, n FROM part JOIN (SELECT body_id, count(*) AS n FROM synapse WHERE body_id % 7 = 0 AND syn_id % 2 = 0 GROUP BY 1) ON body_id = p_partkey)""")
def k16_split_bodies(t: Tables) -> DataFrame:
    """Every seventh body gives its even synapses to a new one."""
    s = _at_rest(t)
    parts = s.where("body_id % 7 = 0 AND syn_id % 2 = 0").groupBy("body_id").agg(F.collect_list("syn_id").alias("synapses"))
    return _sizes(_after(t, parts.select("body_id", F.col("body_id").alias("seq"), F.lit("split").alias("kind"), "synapses", F.array(F.col("body_id") + 1_000_000_000).alias("bodies")), s=s)).select("body_id", "name", "n")


@query(f"""{_EDITED}, moved AS (SELECT s.syn_id, s.body_id AS was, l.body_id AS now, l.syn_id IS NOT NULL AS alive FROM synapse s LEFT JOIN live l USING (syn_id) WHERE l.syn_id IS NULL OR l.body_id IS DISTINCT FROM s.body_id),
    cut AS (SELECT pre_id, post_id FROM edge WHERE pre_id IN (SELECT syn_id FROM gone) OR post_id IN (SELECT syn_id FROM gone)),
    fresh AS (SELECT a.body_id AS pre_body, b.body_id AS post_body, count(DISTINCT post_id) AS weight, count(DISTINCT post_id) FILTER (b.confidence > 0.8) AS weight_hp
        FROM edge JOIN live a ON a.syn_id = pre_id JOIN live b ON b.syn_id = post_id WHERE a.body_id IS NOT NULL AND b.body_id IS NOT NULL GROUP BY 1, 2),
    conn_change AS (SELECT coalesce(o.pre_body, f.pre_body) AS pre_body, coalesce(o.post_body, f.post_body) AS post_body FROM conn o FULL JOIN fresh f ON o.pre_body = f.pre_body AND o.post_body = f.post_body
        WHERE o.weight IS DISTINCT FROM f.weight OR o.weight_hp IS DISTINCT FROM f.weight_hp),
    named AS (SELECT e.body_id, arg_max(props, seq) AS status FROM ev e LEFT JOIN born USING (body_id) WHERE kind = 'click' AND (e.body_id IN (SELECT p_partkey FROM part) OR coalesce(born.at < seq, false)) GROUP BY 1),
    touched AS (
        SELECT 'synapse' AS node, syn_id AS id FROM moved WHERE alive UNION SELECT 'synapse', pre_id FROM cut WHERE pre_id NOT IN (SELECT syn_id FROM gone) UNION SELECT 'synapse', post_id FROM cut WHERE post_id NOT IN (SELECT syn_id FROM gone)
        UNION SELECT 'body', body_id FROM born WHERE body_id NOT IN (SELECT p_partkey FROM part) UNION SELECT 'body', body_id FROM named LEFT JOIN part ON p_partkey = body_id WHERE status IS DISTINCT FROM p_brand
        UNION SELECT 'body', was FROM moved WHERE was IS NOT NULL UNION SELECT 'body', now FROM moved WHERE now IS NOT NULL UNION SELECT 'body', pre_body FROM conn_change UNION SELECT 'body', post_body FROM conn_change
        UNION SELECT 'dataset', 0)
    SELECT node, id, date_trunc('second', (SELECT max(ts) FROM events)) AS ts FROM touched""")
def k21_stamps_of_edits(t: Tables) -> DataFrame:
    """Nodes that the edits stamp: changed ones and the ends of changed relationships, connections included; and the dataset's
    last edit."""
    old = _stored(t)
    part = K.edited(old, _edit_log(t))
    touched = K.touched_by(old, part, pre_hp=0.2, post_hp=0.8)
    time = F.date_trunc("second", F.lit(t.read("events").agg(F.max("ts").alias("t")).first().t))
    rows = [touched[node].select(F.lit(node).alias("node"), F.col(f"{key}_id").alias("id"), time.alias("ts")) for node, key in (("synapse", "syn"), ("body", "body"))]
    return reduce(DataFrame.unionByName, rows).unionByName(last_edit_of(touched, time).select(F.lit("dataset").alias("node"), F.lit(0).cast("long").alias("id"), F.col("last_edit").alias("ts")))


_VERSION = "SELECT {k} AS version, body_id, coalesce(last.status, p_brand) AS status, coalesce(n, 0) AS n FROM (SELECT p_partkey AS body_id FROM part UNION SELECT body_id FROM born{k}) LEFT JOIN part ON p_partkey = body_id LEFT JOIN last{k} last USING (body_id) LEFT JOIN (SELECT body_id, count(*) AS n FROM live{k} WHERE body_id IS NOT NULL GROUP BY 1) USING (body_id)"
_UPTO = """, ev{k} AS (SELECT event_id AS seq, user_id AS body_id, event_type AS kind, ((event_id * 7) % (SELECT count(*) FROM orders)) * 1000 + event_id % 3 + 1 AS syn_id, props FROM events WHERE event_id <= (SELECT {k} * max(event_id) // 2 FROM events)),
    born{k} AS (SELECT body_id, min(seq) AS at FROM ev{k} WHERE kind = 'signup' GROUP BY 1),
    own{k} AS (SELECT syn_id, arg_max({{'b': CASE WHEN kind = 'purchase' THEN body_id END}}, seq) AS o FROM ev{k} LEFT JOIN born{k} born USING (body_id)
        WHERE kind = 'view' OR kind = 'purchase' AND (body_id IN (SELECT p_partkey FROM part) OR coalesce(born.at < seq, false)) GROUP BY 1),
    live{k} AS (SELECT s.syn_id, CASE WHEN own.syn_id IS NULL THEN s.body_id ELSE own.o.b END AS body_id FROM synapse s LEFT JOIN own{k} own USING (syn_id) WHERE s.syn_id NOT IN (SELECT syn_id FROM ev{k} WHERE kind = 'error')),
    last{k} AS (SELECT e.body_id, arg_max(props, seq) AS status FROM ev{k} e LEFT JOIN born{k} born USING (body_id) WHERE kind = 'click' AND (e.body_id IN (SELECT p_partkey FROM part) OR coalesce(born.at < seq, false)) GROUP BY 1)"""


@query(f"{_UPTO.format(k=1)}{_UPTO.format(k=2)} {_VERSION.format(k=1)} UNION ALL {_VERSION.format(k=2)}")
def l01_store_versions(t: Tables) -> DataFrame:
    """Bodies in both versions of a store that takes the edits in two batches, the second of them twice."""
    spark, path = t.spark, f"{G.shared_folder(t.spark)}/store/{uuid.uuid4().hex}"
    save_snapshot(_stored(t), path, 0)
    edits = _edit_log(t)
    half = F.lit(edits.agg(F.max("seq")).first()[0] // 2)
    for version, part in ((0, edits.where(F.col("seq") <= half)), (1, edits.where(F.col("seq") > half)), (1, edits.where(F.col("seq") > half))):
        apply_batch(spark, path, version, part)
    rows = [_sizes(load_snapshot(spark, path, v)).select(F.lit(v).alias("version"), "body_id", "status", "n") for v in (1, 2)]
    return rows[0].unionByName(rows[1])


# The same in SQL


def _sql(t: Tables) -> SparkSession:
    register_graph(t.spark, t.synapse, t.edges, t.body, _axis(t), t.skel_node)
    return t.spark


@query("SELECT p_partkey AS body_id, roi, inputs, outputs FROM part JOIN (SELECT body_id, roi, post AS inputs, pre AS outputs FROM body_roi UNION ALL SELECT body_id, 'total', post, pre FROM body_n) ON body_id = p_partkey")
def m04_roi_counts_in_sql(t: Tables) -> DataFrame:
    return _sql(t).sql("SELECT b.body_id, c.* FROM graph_body b, LATERAL roi_counts(b.body_id) c")


@query(f", {_AXIS} SELECT vec.* FROM vec JOIN body_n USING (body_id) WHERE pre + post > 20")
def m04_feature_vectors_in_sql(t: Tables) -> DataFrame:
    return _vectors(_sql(t).sql("SELECT * FROM feature_vectors(20)"))


@query(f", {_AXIS} SELECT vec.* FROM vec JOIN body_n b USING (body_id) JOIN body_roi r USING (body_id) WHERE b.pre + b.post > 20 AND r.roi = 'ASIA' AND r.pre + r.post > 5")
def m04_feature_vectors_in_region_in_sql(t: Tables) -> DataFrame:
    return _vectors(_sql(t).sql("SELECT * FROM feature_vectors_in('ASIA', 5, 20)"))


@query(ORACLE_SQL["e14_feature_vectors_topx"].removeprefix(f"WITH RECURSIVE {ORACLE} "))
def m04_feature_vectors_topx_in_sql(t: Tables) -> DataFrame:
    rows = _sql(t).sql("SELECT * FROM feature_vectors_topx('ASIA', 8, 20, 5)")
    text = lambda c: F.array_join(F.array_sort(F.transform(c, lambda x: x.cast("string"))), ",")
    return _vectors(rows.withColumns({"i": text("input_ids"), "o": text("output_ids")}), "i", "o", "is_primary").withColumnsRenamed({"i": "input_ids", "o": "output_ids"})


@query(ORACLE_SQL["e15_connection_categories"].removeprefix(f"WITH RECURSIVE {ORACLE} "))
def m04_categories_in_sql(t: Tables) -> DataFrame:
    return _sql(t).sql("SELECT b.body_id, c.category, c.pre, c.post FROM graph_body b, LATERAL connection_categories(b.body_id) c")


@query(f", {_TOP} SELECT body_id, partner, is_out, weight FROM top WHERE rank <= 3")
def m04_top_partners_in_sql(t: Tables) -> DataFrame:
    return _sql(t).sql("SELECT b.body_id, p.* FROM graph_body b, LATERAL top_partners(b.body_id, 3) p")


@query(f""", {_VERTEX}, body AS (SELECT min(body_id) AS b FROM body_n WHERE pre + post = (SELECT max(pre + post) FROM body_n)), own AS (SELECT *, concat(pre_body, '_', post_body) AS v FROM vertex, body WHERE (pre_body = b OR post_body = b) AND pre + post > 1)
    SELECT a.v AS source, b.v AS target, CAST(floor(sqrt(CAST((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 AS DOUBLE)) + 0.5) AS BIGINT) AS distance FROM own a JOIN own b ON a.v < b.v""")
def m04_line_graph_in_sql(t: Tables) -> DataFrame:
    """Of the body with the most synapses."""
    body = A.body_counts(t.synapse).orderBy(F.desc(F.col("pre") + F.col("post")), "body_id").first().body_id
    return _sql(t).sql(f"SELECT * FROM line_graph({body}, 1)")


@query(f""", {_CENTROID}, d AS (SELECT s.body_id, s.x, s.y, s.z, row_number() OVER (PARTITION BY s.body_id ORDER BY (s.x - c.x) ** 2 + (s.y - c.y) ** 2 + (s.z - c.z) ** 2, s.x, s.y, s.z) AS rn FROM synapse s JOIN centroid c USING (body_id)),
    r AS (SELECT body_id, string_agg(roi, '|' ORDER BY roi) AS rois FROM body_roi GROUP BY 1)
    SELECT p_partkey AS body_id, coalesce(x, 0) AS x, coalesce(y, 0) AS y, coalesce(z, 0) AS z, rois FROM part LEFT JOIN (SELECT * FROM d WHERE rn = 1) d ON d.body_id = p_partkey LEFT JOIN r ON r.body_id = p_partkey""")
def m04_scalars_in_sql(t: Tables) -> DataFrame:
    return _sql(t).sql("SELECT body_id, neuron_centroid(body_id).x AS x, neuron_centroid(body_id).y AS y, neuron_centroid(body_id).z AS z, array_join(segment_rois(body_id), '|') AS rois FROM graph_body")
