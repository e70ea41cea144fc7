"""Readers, checks and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from axonweave.functions import columns as C
from axonweave.operators import relate as H
from axonweave.operators import validate as V
from axonweave.sources import readers as S
from axonweave.sources import sinks as W


def put(path, text):
    path.write_text(text)
    return str(path)


def test_json_tables(spark, tmp_path):
    syn = [{"type": "pre", "location": [1, 2, 3], "confidence": 0.5, "rois": ["seven_column_roi", "A", "B"]}, {"type": "post", "location": [4, 5, 6]}, {"type": "dendrite", "location": [1, 2, 3]}, {"type": "pre", "location": [1.5, 2, 3]}, {"type": "pre", "location": [1, 2]}, {"type": "pre", "location": [1, 2, 3], "confidence": 1.5}, {"location": [1, 2, 3]}]
    p = put(tmp_path / "s.json", json.dumps(syn))
    good, bad = V.check_synapses(S.raw_synapses(spark, p))
    assert good.count() == 2 and {r.reason for r in bad.collect()} == {"type is neither pre nor post", "location is not three whole numbers", "confidence is outside 0 to 1", "type is missing"}
    rows = S.read_synapses(spark, p).where("x = 1 AND confidence = 0.5 OR x = 4").orderBy("x").collect()
    assert rows[0].rois == ["A", "B"] and rows[1].confidence == 0.0 and rows[1].rois == []
    lines = put(tmp_path / "s.jsonl", "\n".join(map(json.dumps, syn)))
    assert S.raw_synapses(spark, lines, lines=True).count() == 7

    e = put(tmp_path / "e.json", json.dumps([{"pre": [1, 2, 3], "post": [4, 5, 6]}, {"pre": [1, 2, 3]}]))
    links = S.read_syn_edges(spark, e)
    assert links.first().post.z == 6
    raw = spark.read.schema("pre ARRAY<BIGINT>, post ARRAY<BIGINT>").option("multiLine", True).json(e)
    assert [x.count() for x in V.check_edges(raw)] == [1, 1]

    bodies = [{"id": 7, "name": "n", "soma": {"location": [1, 2, 3], "radius": 5.0}, "synapseSet": [[1, 2, 3], [4, 5, 6]]}, {"id": 8, "soma": {}}, {"name": "no id"}, {"id": 9.5}, {"id": 10, "soma": {"radius": 1.0}}]
    p = put(tmp_path / "b.json", json.dumps(bodies))
    body, member = S.read_bodies(spark, p)
    rows = {r.body_id: r for r in body.collect()}
    assert rows[7].soma.radius == 5.0 and rows[8].soma is None and member.where("body_id = 7").count() == 2
    good, bad = V.check_bodies(spark.read.schema(S.BODY_JSON).option("multiLine", True).json(p))
    assert good.count() == 2 and {r.reason for r in bad.collect()} == {"id is missing", "id is no whole number", "soma lacks location or radius"}

    nested = put(tmp_path / "r.json", json.dumps([{"Pos": [1, 2, 3], "Kind": "PreSyn", "Rels": [{"Rel": "PreSynTo", "To": [4, 5, 6]}, {"Rel": "Other", "To": [0, 0, 0]}]}, {"Pos": [4, 5, 6], "Kind": "PostSyn", "Rels": [{"Rel": "PostSynTo", "To": [1, 2, 3]}]}]))
    assert [(r.pre.x, r.post.x) for r in S.read_synapse_rels(spark, nested).collect()] == [(1, 4)]
    meta = put(tmp_path / "m.json", json.dumps({"uuid": "u", "info": "i"}))
    assert S.read_meta(spark, meta).first().uuid == "u"


def test_skeletons(spark, tmp_path):
    put(tmp_path / "101.swc", "# {\"mutation id\": 77}\n1 0 5464 9385 1248 4 -1\n2 2 5224 9313.8 1462.4 28.5 1\n")
    put(tmp_path / "102_swc", "1 0 -2.5 2.5 0.5 1 -1\n")
    rows = {(r.body_id, r.row_no): r for r in S.read_skeletons(spark, str(tmp_path)).collect()}
    assert (rows[101, 2].y, rows[101, 2].z, rows[101, 2].parent_row) == (9314, 1462, 1)
    assert (rows[102, 1].x, rows[102, 1].y, rows[102, 1].z) == (-2, 3, 1)
    assert {r.body_id: r.mutation_id for r in S.skeleton_mutations(spark, str(tmp_path)).collect()} == {101: 77, 102: None}


def test_csv_tables(spark, tmp_path):
    p = put(tmp_path / "m.csv", "syn_id,x,y,z,type,confidence,super_roi,sub1_roi,sub2_roi,sub3_roi,body_id\n5,1,2,3,PreSyn,0.5,A,A|x,<unspecified>,,9\n6,1,2,3,PostSyn,0.5,A,,,,0\n")
    rows = S.read_mapped_synapses(spark, p).collect()
    assert [(r.syn_id, r.type, r.rois) for r in rows] == [(5, "pre", ["A", "A,x"])]
    p = put(tmp_path / "s.csv", "x,y,z,kind,conf\n9,2,3,PreSyn,0.5\n1,2,3,PostSyn,0.25\n")
    rows = S.with_synapse_ids(S.read_synapse_csv(spark, p)).orderBy("x").collect()
    assert [(r.x, r.type, r.syn_id) for r in rows] == [(1, "post", 99000000000), (9, "pre", 99000000001)]
    info = spark.createDataFrame([(1, 2, 3, {"B": (1, 1), "A": (1, 2)})], "body_id long, pre long, post long, roi_info map<string,struct<pre:bigint,post:bigint>>")
    W.write_body_counts(info, str(tmp_path / "counts"))
    assert "".join(f.read_text() for f in (tmp_path / "counts").glob("part*")).strip() == '1;2;3;{"A":{"pre":1,"post":2},"B":{"pre":1,"post":1}}'
    assert S.read_body_counts(spark, str(tmp_path / "counts")).first().roi_info["A"].post == 2
    assert S.read_sizes(spark, put(tmp_path / "z.csv", "body,size\n1,50\n")).first().size == 50
    assert S.read_annotations(spark, put(tmp_path / "a.json", '{"body ID": 4, "primary neurite": "p"}')).first().primary_neurite == "p"
    assert {r.name for r in S.read_roi_list(spark, put(tmp_path / "r.txt", "A\n\nB\n")).collect()} == {"A", "B"}
    tree = {"name": "brain", "children": [{"name": "A", "children": [{"name": "A1"}]}, {"name": "B"}]}
    assert sorted((r.name, r.parent or "", r.level) for r in S.read_roi_tree(spark, put(tmp_path / "t.json", json.dumps(tree))).collect()) == [("A", "brain", 1), ("A1", "A", 2), ("B", "brain", 1), ("brain", "", 0)]


def test_writers(spark, tmp_path):
    syn = spark.createDataFrame([(1, 5, 6, 7, "pre", 0.5, ["A"]), (2, 5, 6, 8, "post", 0.25, [])], "syn_id long, x long, y long, z long, type string, confidence double, rois array<string>")
    W.write_synapses_csv(syn, str(tmp_path / "syn"), "ds", ["A", "B"])
    back = S.read_graph_csv(spark, str(tmp_path / "syn"), "id BIGINT, type STRING, confidence DOUBLE, location STRING, a BOOLEAN, b BOOLEAN, label STRING").orderBy("id").collect()
    assert back[0].a is True and back[0].b is None and back[0].location == "{x:5, y:6, z:7}" and back[1].label == "Synapse;PostSyn;ds_Synapse;ds_PostSyn"
    body = spark.createDataFrame([(1, 2, 3, True, "a, \"b\"", {"A": (2, 3)})], "body_id long, pre long, post long, is_neuron boolean, type string, roi_info map<string,struct<pre:bigint,post:bigint>>")
    W.write_bodies_csv(body, str(tmp_path / "body"), "ds", ["A"])
    row = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "body")).first()
    assert row["type:string"] == 'a, "b"' and json.loads(row["roiInfo:string"]) == {"A": {"pre": 2, "post": 3}} and row[":LABEL"].endswith("Neuron;ds_Neuron")
    W.write_graph({"synapse": syn}, str(tmp_path / "g"), "ds")
    assert spark.read.parquet(str(tmp_path / "g/synapse")).where("dataset = 'ds'").count() == 2
    assert json.loads(W.as_json_text(syn.select("type", "syn_id"), "type").where("type = 'pre'").first().json) == [{"syn_id": 1}]
    for f, df in ((W.write_syn_edges_csv, "pre_id long, post_id long"), (W.write_set_members_csv, "set_id string, syn_id long"), (W.write_set_links_csv, "from_set string, to_set string"), (W.write_body_sets_csv, "body_id long, set_id string"), (W.write_body_rois_csv, "body_id long, roi string, pre long, post long"), (W.write_set_rois_csv, "set_id string, roi string, weight long, weight_hp long"), (W.write_body_ids, "body_id long"), (W.write_connections_csv, "pre_body long, post_body long, weight long, weight_hp long, roi_info map<string,struct<pre:bigint>>")):
        f(spark.createDataFrame([], df), str(tmp_path / f.__name__))
    W.write_synapse_sets_csv(spark.createDataFrame([("1_2_pre",)], "set_id string"), str(tmp_path / "sets"), "ds")


def test_scalars(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("v")).first().v
    assert [get(C.half_up(F.lit(x))) for x in (-2.5, 2.5, 2.4)] == [-2, 3, 2]
    assert get(C.point(F.lit(1), F.lit(None).cast("int"), F.lit(2))) is None
    assert [get(C.status_of(F.lit(s))) for s in ("Leaves", "Roughly traced", "Orphan-artifact", "0.5assign", "Hard")] == ["Traced", "Traced", "Orphan", "Assign", "Hard"]
    assert [get(C.cropped_of(F.lit(s))) for s in ("Leaves", "Traced", "Hard")] == [True, False, None]
    assert get(C.default_status(F.lit(""), F.lit(2), F.lit(0))) == "Assign" and get(C.default_status(F.lit("x"), F.lit(2), F.lit(0))) == "x"
    assert get(C.clean_text(F.lit("a,b\n"))) == "ab" and get(C.is_high(F.lit(None).cast("double"), 0.1)) is False
    assert get(C.is_reserved(F.lit("Neuron"))) and get(C.id_part(C.composite_id(F.lit("d"), F.lit(5)), 1)) == "5"
    info = F.from_json(F.lit('{"A":{"pre":1,"post":0}}'), "map<string,struct<pre:bigint,post:bigint>>")
    rois = F.array(F.lit("A"), F.lit("B"))
    assert {k: tuple(v) for k, v in get(C.roi_add(info, rois, F.lit("post"))).items()} == {"A": (1, 1), "B": (0, 1)}
    assert get(C.roi_remove(info, F.array(F.lit("A")), F.lit("pre"))) == {}
    assert get(C.region_name(info, F.lit(0), F.lit(0), 0.1, rois)) == "none-none"  # no division by zero
    with pytest.raises(ValueError):
        V.check_dataset("Meta")


def test_points_in_runs(spark):
    runs = spark.createDataFrame([(0, 0, 0, 200, "A"), (0, 1, 5, 5, "B")], "z long, y long, x0 long, x1 long, name string")
    points = spark.createDataFrame([(1, 130, 0, 0), (2, 5, 1, 0), (3, 6, 1, 0), (4, 201, 0, 0)], "id long, x long, y long, z long")
    assert {r.id: r.name for r in H.map_points(points, runs, "name").collect()} == {1: "A", 2: "B", 3: None, 4: None}
    scaled = spark.createDataFrame([(1, 40, 70, 5)], "id long, x long, y long, z long")
    blocks = spark.createDataFrame([(0, 2, 1, 1, "C")], "z long, y long, x0 long, x1 long, name string")
    assert H.map_points(scaled, blocks, "name", scale=5).first().name == "C"
