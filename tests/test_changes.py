"""Change stamps, the delta store, and edits that are refused for what they say."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from axonweave.operators.aggregate import connections
from axonweave.operators.relate import resolve_edges, with_bodies
from axonweave.plans.changes import KEYS, changes, delta, stamp, touched_nodes, with_delta
from axonweave.plans.edits import apply_edits, changed_rows, edited, merged, new_edits, touched_by
from axonweave.streaming.feed import apply_batch, compact, load_snapshot, save_snapshot, versions
from test_edits import OneByOne, log, random_log, seen, tables, wanted

OLD, NOW = datetime(2020, 1, 1), datetime(2024, 5, 5, 1, 2, 3, 999)


def test_changes_and_deltas(spark):
    schema = "k int, v string, m map<string,int>, ts timestamp"
    old = spark.createDataFrame([(1, "a", {"x": 1, "y": 2}, OLD), (2, None, None, OLD), (3, "c", {}, OLD), (None, "n", None, OLD), (5, "e", None, OLD)], schema)
    new = spark.createDataFrame([(1, "a", {"y": 2, "x": 1}, NOW), (2, "b", None, OLD), (4, "d", None, OLD), (None, "n", None, OLD), (5, "e", {}, OLD)], schema)
    assert {(r.k, r.change) for r in changes(old, new, ["k"]).collect()} == {(2, "changed"), (3, "deleted"), (4, "added"), (5, "changed")}
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    assert [(r.k, r.change) for r in changes(keys, keys.where("k = 1"), ["k"]).collect()] == [(2, "deleted")]
    steps = [spark.createDataFrame(rows, "k int, v string") for rows in ([(1, "a"), (2, "b"), (3, "c")], [(1, "A"), (3, "c"), (4, "d")], [(1, "A"), (2, "again"), (4, None)])]
    parts = [delta(a, b, ["k"]) for a, b in zip(steps, steps[1:])]
    assert [p.count() for p in parts] == [3, 3]
    for n in (0, 1, 2):
        assert sorted(map(tuple, with_delta(steps[0], parts[:n], ["k"]).collect())) == sorted(map(tuple, steps[n].collect()))


def stamped_graph(spark):
    at = F.lit(OLD)
    g = {
        "synapse": spark.createDataFrame([(1, "pre", 1.0), (2, "post", 1.0), (3, "post", 1.0), (4, "post", 1.0)], "syn_id long, type string, confidence double").withColumn("ts", at),
        "syn_edge": spark.createDataFrame([(1, 2), (1, 3)], "pre_id long, post_id long"),
        "membership": spark.createDataFrame([(10, 1), (20, 2), (30, 4)], "body_id long, syn_id long"),
        "body": spark.createDataFrame([(10, "a"), (20, None), (30, "c"), (40, None)], "body_id long, name string").withColumn("ts", at),
        "connection": spark.createDataFrame([(10, 20, 1)], "pre_body long, post_body long, weight long"),
    }
    return g


def stamps(old, new, **options):
    marked, last = stamp(old, new, NOW, **options)
    out = {t: sorted(r[KEYS[t][0]] for r in marked[t].where(F.year("ts") == 2024).collect()) for t in ("synapse", "body")}
    return out["synapse"], out["body"], last.first().last_edit


def test_stamps_follow_changes(spark):
    g = stamped_graph(spark)
    second = NOW.replace(microsecond=0)
    # nothing changed, or stamps alone: nothing is stamped
    assert stamps(g, g) == ([], [], None)
    assert stamps(g, g | {"body": g["body"].withColumn("ts", F.lit(datetime(2023, 1, 1)))}) == ([], [], None)
    before = spark.createDataFrame([(OLD,)], "last_edit timestamp")
    assert stamps(g, g, last_edit=before)[2] == OLD
    # a property is set, removed; a node comes, or goes
    body = lambda sql: g | {"body": g["body"].withColumn("name", F.expr(sql))}
    assert stamps(g, body("if(body_id = 20, 'new', name)"), last_edit=before) == ([], [20], second)
    assert stamps(g, body("if(body_id = 10, null, name)")) == ([], [10], second)
    assert stamps(g, g | {"body": g["body"].unionByName(spark.createDataFrame([(50, "x", None)], "body_id long, name string, ts timestamp"))}) == ([], [50], second)
    assert stamps(g, g | {"body": g["body"].where("body_id <> 40")}) == ([], [], None)
    # relationships: both ends of what comes, goes or changes; ends that are gone are not stamped
    assert stamps(g, g | {"syn_edge": g["syn_edge"].where("post_id = 2")}) == ([1, 3], [], second)
    assert stamps(g, g | {"syn_edge": g["syn_edge"].where("post_id = 2"), "synapse": g["synapse"].where("syn_id <> 3")}) == ([1], [], second)
    moved = g["membership"].withColumn("body_id", F.expr("if(syn_id = 2, 30, body_id)"))
    assert stamps(g, g | {"membership": moved}) == ([2], [20, 30], second)
    assert stamps(g, g | {"connection": g["connection"].withColumn("weight", F.lit(2).cast("long"))}) == ([], [10, 20], second)
    # stamping again changes nothing
    once, _ = stamp(g, g | {"membership": moved}, NOW)
    again, last = stamp(once, dict(once), datetime(2030, 1, 1))
    assert last.first().last_edit is None and again["body"].where("year(ts) = 2030").count() == 0


@pytest.mark.parametrize("seed", (11,))
def test_store_versions(spark, tmp_path, seed):
    model, edits = random_log(seed, 24)
    path = str(tmp_path / "store")
    base = tables(spark, model.base)
    save_snapshot(base, path, 0)
    whole = apply_edits(base, log(spark, edits[:12]))[0]
    for version, part in ((0, edits[:12]), (1, edits[12:]), (1, edits[12:])):  # the second batch runs twice
        apply_batch(spark, path, version, log(spark, part))
    assert seen(load_snapshot(spark, path, 1)) == seen(whole)
    got, want = seen(load_snapshot(spark, path, 2)), wanted(model)
    assert got == want
    compact(spark, path, 2)
    assert seen(load_snapshot(spark, path, 2)) == want and ("base" in {k for v, k, _ in versions(spark, path) if v == 2})
    # a batch that was applied before has no effect, and writes no row
    apply_batch(spark, path, 2, log(spark, edits))
    assert seen(load_snapshot(spark, path, 3)) == want and [t for v, k, t in versions(spark, path) if v == 3] == [[]]
    with pytest.raises(ValueError):
        load_snapshot(spark, path, 9)


def test_only_concerned_rows(spark):
    base = tables(spark, OneByOne(random.Random(0)).base)
    part = edited(base, log(spark, [{"seq": 1, "kind": "orphan_synapse", "syn_id": 3}]))
    assert part.old["synapse"].count() == 1 and part.old["body"].count() <= 1 and part.old["syn_edge"].count() == 0
    assert part.new["membership"].where("syn_id = 3").count() == 0


def test_unchanged_tables_and_deltas_of_keys(spark):
    """Tables that no edit changes are passed on as they are, and of a deleted synapse a delta holds the key."""
    base = tables(spark, OneByOne(random.Random(0)).base)
    part = edited(base, log(spark, [{"seq": 1, "kind": "delete_synapse", "syn_id": 3}, {"seq": 2, "kind": "delete_synapse", "syn_id": 999}]))
    graph, found = merged(base, part), changed_rows(part)
    assert graph["body"] is base["body"] and graph["skel_node"] is base["skel_node"] and "body" not in found
    assert [(r.syn_id, r.type, r._gone) for r in found["synapse"].collect()] == [(3, None, True)]
    assert graph["synapse"].count() == base["synapse"].count() - 1 and graph["membership"].where("syn_id = 3").count() == 0


@pytest.mark.parametrize("seed", (5, 6))
def test_touched_by_edits_as_of_the_whole_graph(spark, seed):
    model, edits = random_log(seed, 24)
    base = tables(spark, model.base)
    part = edited(base, log(spark, edits))
    conns = lambda g: g | {"connection": connections(resolve_edges(g["syn_edge"], with_bodies(g["synapse"], g["membership"])), 0.2, 0.8)}
    want = touched_nodes(conns(base), conns(merged(base, part)))
    got = touched_by(base, part, pre_hp=0.2, post_hp=0.8)
    assert {t: sorted(map(tuple, k.collect())) for t, k in got.items()} == {t: sorted(map(tuple, k.collect())) for t, k in want.items()}


def test_posts_of_several_links_touch_as_they_count(spark):
    """A second link of a post from the same body adds nothing to a connection; one that goes from another body ends a connection."""
    base = tables(spark, OneByOne(random.Random(0)).base)
    synapse = spark.createDataFrame([(1, "pre", 1.0), (2, "pre", 1.0), (3, "pre", 1.0), (4, "post", 1.0)], "syn_id long, type string, confidence double")
    synapse = synapse.select("syn_id", *((F.col("syn_id") if c in "xyz" else F.col(c) if c in synapse.columns else F.lit(None)).cast(t).alias(c) for c, t in base["synapse"].dtypes if c != "syn_id"))
    graph = base | {
        "synapse": synapse, "syn_edge": spark.createDataFrame([(1, 4), (2, 4), (3, 4)], "pre_id long, post_id long"),
        "membership": spark.createDataFrame([(1, 1), (1, 2), (2, 3), (3, 4)], "body_id long, syn_id long"), "body": base["body"].where("body_id <= 3"),
    }
    touch = lambda syn: {t: sorted(r[0] for r in k.collect()) for t, k in touched_by(graph, edited(graph, log(spark, [{"seq": 1, "kind": "delete_synapse", "syn_id": syn}]))).items()}
    assert touch(2) == {"synapse": [4], "body": [1], "skel_node": []}
    assert touch(3) == {"synapse": [4], "body": [2, 3], "skel_node": []}


def test_arguments_and_kinds(spark):
    base = tables(spark, OneByOne(random.Random(0)).base)
    place = {"type": "pre", "x": 900, "y": 1}
    edits = [
        {"seq": 1, "kind": "mergee", "bodies": [1, 2]}, {"seq": 2}, {"seq": -5, "kind": "delete_neuron", "body_id": 1}, {"seq": 4, "kind": "merge", "bodies": [1, 1]}, {"seq": 5, "kind": "merge", "bodies": [1, None]},
        {"seq": 6, "kind": "add_roi", "syn_id": 1}, {"seq": 7, "kind": "add_neuron", "props": {}}, {"seq": 8, "kind": "add_synapse", "syn_id": 700, **place}, {"seq": 9, "kind": "add_synapse", **place, "z": 1},
        {"seq": 10, "kind": "add_synapse", "syn_id": 701, **place, "z": 1, "confidence": 7.0}, {"seq": 11, "kind": "update_properties", "body_id": 1, "props": {"nmae": "x"}}, {"seq": 12, "kind": "update_properties", "body_id": 1, "props": {"size": "many"}},
        {"seq": 13, "kind": "set_properties", "body_id": 1, "props": {"size": "12"}}, {"seq": 14, "kind": "delete_skeleton", "body_id": 2}, {"seq": 15, "kind": "add_skeleton", "body_id": 1, "skeleton": [{"row_no": 1}]}, {"seq": 16, "kind": "delete_skeleton", "body_id": 777},
        {"seq": 17, "kind": "add_synapse", "syn_id": 702, **place, "z": 5, "rois": ["B", "A", "B", None]}, {"seq": 18, "kind": "update_properties", "body_id": 2},
    ]
    graph, _, rejected = apply_edits(base, log(spark, [e for e in edits if e["seq"] > 0]).unionByName(log(spark, [{**edits[2], "seq": 3}]).withColumn("seq", F.lit(-5).cast("long"))))
    assert {r.seq: r.reason for r in rejected.collect()} == {
        1: "unknown kind", 2: "unknown kind", -5: "seq is negative", 4: "malformed", 5: "malformed", 6: "malformed", 7: "malformed", 8: "synapse has no place", 9: "malformed", 10: "synapse has a confidence outside 0 to 1",
        11: "unknown attribute", 12: "value does not parse", 14: "skeleton is absent", 15: "skeleton exists", 16: "skeleton is absent", 18: "malformed"}
    assert graph["body"].where("body_id = 1").first().size == 12
    assert sorted(graph["synapse"].where("syn_id = 702").first().rois) == ["A", "B"]


def test_one_edit_of_a_key(spark):
    rows = log(spark, [{"seq": 1, "kind": "delete_neuron", "body_id": 1}, {"seq": 1, "kind": "delete_neuron", "body_id": 2}, {"seq": 0, "kind": "delete_neuron", "body_id": 3}]).withColumn("mutation_key", F.when(F.col("seq") == 1, "same").otherwise("other"))
    got = new_edits(rows, None)
    assert got.count() == 2 and got.where("mutation_key = 'same'").count() == 1
    assert [r.mutation_key for r in new_edits(rows, spark.createDataFrame([("same",)], "mutation_key string")).collect()] == ["other"]


def test_a_table_with_a_delta_is_dealt_anew_for_a_join(spark):
    """Adaptive plans may give one part of the union other partitions than the other, so joins must not rely on them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(0, 400, 1, 11).select("id", (F.col("id") % 7).alias("v"))
        part = spark.range(0, 300, 1, 3).select((F.col("id") * 7 % 300).alias("id"), F.lit(9).cast("long").alias("v")).withColumn("_gone", F.col("id") % 2 == 0)
        joined = with_delta(base, [part], ["id"]).join(spark.range(0, 400, 1, 5).select("id", F.lit(1).alias("w")), "id")
        above, _, _ = joined._jdf.queryExecution().executedPlan().toString().partition("Union")
        assert above.count("Exchange") == 1
        assert joined.agg(F.count("*"), F.sum("v")).first() == (250, sum(i % 7 for i in range(300, 400)) + 9 * 150)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
