"""Edit logs: the set-wise result equals edits applied one by one, in one batch or in several."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from axonweave.plans.edits import apply_edits, stamped, without_repeats
from axonweave.plans.load import derive, refresh
from axonweave.schemas import EDIT, MEMBERSHIP, SKEL_NODE, SYN_EDGE, SYNAPSE
from axonweave.sources.readers import read_edits, stream_edits
from axonweave.streaming.feed import follow, load_snapshot, save_snapshot

BODY = "body_id BIGINT, name STRING, status STRING, size BIGINT, soma STRUCT<x: BIGINT, y: BIGINT, z: BIGINT, radius: DOUBLE>"


class OneByOne:
    """The model: each edit changes dictionaries."""

    def __init__(self, rng):
        self.syn = {i: {"type": "pre" if i % 3 == 0 else "post", "rois": {"A"} if i % 2 else {"B"}} for i in range(1, 41)}
        self.links = {(i, j) for i in self.syn for j in (i + 1, i + 2) if i % 3 == 0 and j in self.syn}
        self.body = {b: {"name": f"n{b}" if b % 2 else None, "status": None, "size": b} for b in range(1, 9)}
        self.owner = {i: rng.randrange(1, 9) for i in self.syn if i % 7}
        self.base = ({i: dict(v, rois=set(v["rois"])) for i, v in self.syn.items()}, set(self.links), {b: dict(v) for b, v in self.body.items()}, dict(self.owner))

    def random_edit(self, rng, seq):
        e = {"seq": seq, "kind": rng.choice(["add_synapse", "delete_synapse", "orphan_synapse", "add_synapse_to_segment", "add_synapse_to_segment", "add_neuron", "delete_neuron", "merge", "split", "add_roi", "remove_roi", "update_properties", "set_properties", "add_link"])}
        e["syn_id"], e["body_id"] = rng.randrange(1, 46), rng.choice([*self.body, 99])
        k = e["kind"]
        if k == "add_synapse":
            e |= {"type": rng.choice(["pre", "post"]), "x": e["syn_id"], "y": 0, "z": 0, "confidence": 0.9}
        elif k == "add_neuron":
            e |= {"body_id": 100 + seq, "synapses": [i for i in self.syn if i not in self.owner][:2], "props": {"name": f"new{seq}"}}
        elif k == "merge":
            if len(self.body) < 4:
                return None
            e["bodies"] = rng.sample(sorted(self.body), rng.choice([2, 3]))
        elif k == "split":
            own = [i for i, b in self.owner.items() if b == e["body_id"]]
            if not own:
                return None
            e |= {"bodies": [200 + seq], "synapses": own[:2]}
        elif k in ("add_roi", "remove_roi"):
            e["roi"] = rng.choice("ABC")
        elif k == "update_properties":
            e["props"] = {"status": f"s{seq}", "name": rng.choice([None, f"m{seq}"])}
        elif k == "set_properties":
            e["props"] = {"status": rng.choice([None, f"t{seq}"])}
        elif k == "add_link":
            pre, post = [i for i in self.syn if self.syn[i]["type"] == "pre"], [i for i in self.syn if self.syn[i]["type"] == "post"]
            e |= {"syn_id": rng.choice(pre), "post_id": rng.choice(post)}
        if k in ("add_synapse", "delete_synapse", "orphan_synapse", "add_roi", "remove_roi", "add_link"):
            e.pop("body_id")
        elif k != "add_synapse_to_segment":
            e.pop("syn_id")
        self.apply(e)
        return e

    def apply(self, e):
        k, s, b = e["kind"], e.get("syn_id"), e.get("body_id")
        if k == "add_synapse" and s not in self.syn:
            self.syn[s] = {"type": e["type"], "rois": set()}
        elif k == "delete_synapse" and s in self.syn:
            del self.syn[s]
            self.owner.pop(s, None)
            self.links = {x for x in self.links if s not in x}
        elif k == "orphan_synapse":
            self.owner.pop(s, None)
        elif k == "add_synapse_to_segment" and s in self.syn and b in self.body:
            self.owner[s] = b
        elif k == "add_neuron":
            self.body[b] = {"name": e["props"]["name"], "status": None, "size": None}
            self.owner |= {i: b for i in e["synapses"]}
        elif k == "delete_neuron" and b in self.body:
            del self.body[b]
            self.owner = {i: o for i, o in self.owner.items() if o != b}
        elif k == "merge":
            first, rest = e["bodies"][0], e["bodies"][1:]
            for c in rest:
                old = self.body.pop(c)
                for a in ("name", "status"):
                    self.body[first][a] = self.body[first][a] if self.body[first][a] is not None else old[a]
                self.body[first]["size"] = sum(filter(None, (self.body[first]["size"], old["size"]))) or None
            self.owner = {i: first if o in rest else o for i, o in self.owner.items()}
        elif k == "split" and b in self.body:
            self.body[e["bodies"][0]] = dict(self.body[b])
            self.owner |= {i: e["bodies"][0] for i in e["synapses"]}
        elif k == "add_roi" and s in self.syn:
            self.syn[s]["rois"].add(e["roi"])
        elif k == "remove_roi" and s in self.syn:
            self.syn[s]["rois"].discard(e["roi"])
        elif k == "update_properties" and b in self.body:
            self.body[b] |= {a: v for a, v in e["props"].items() if v is not None}
        elif k == "set_properties" and b in self.body:
            self.body[b] |= e["props"]
        elif k == "add_link" and s not in self.owner and e["post_id"] not in self.owner:
            self.links.add((s, e["post_id"]))


def tables(spark, base):
    syn, links, body, owner = base
    return {
        "synapse": spark.createDataFrame([(i, i, 0, 0, v["type"], 0.9, sorted(v["rois"])) for i, v in syn.items()], SYNAPSE),
        "syn_edge": spark.createDataFrame(sorted(links), SYN_EDGE),
        "membership": spark.createDataFrame([(b, i) for i, b in owner.items()], MEMBERSHIP),
        "body": spark.createDataFrame([(b, v["name"], v["status"], v["size"], None) for b, v in body.items()], BODY),
        "skel_node": spark.createDataFrame([(1, 1, 0, 0, 0, 0, 1.0, -1)], SKEL_NODE),
    }


def log(spark, edits):
    start = datetime(2024, 1, 1)
    rows = [json.dumps({**e, "ts": (start + timedelta(seconds=e["seq"])).isoformat(), "mutation_key": f"k{e['seq']}"}) for e in edits]
    return spark.createDataFrame([(r,) for r in rows], "v string").select(F.from_json("v", EDIT).alias("e")).select("e.*")


def seen(graph):
    return {
        "owner": {r.syn_id: r.body_id for r in graph["membership"].collect()},
        "syn": {r.syn_id: (r.type, tuple(sorted(r.rois))) for r in graph["synapse"].collect()},
        "links": {tuple(r) for r in graph["syn_edge"].collect()},
        "body": {r.body_id: (r.name, r.status) for r in graph["body"].collect()},
    }


def wanted(model):
    return {"owner": model.owner, "syn": {i: (v["type"], tuple(sorted(v["rois"]))) for i, v in model.syn.items()}, "links": model.links, "body": {b: (v["name"], v["status"]) for b, v in model.body.items()}}


def random_log(seed, n=40, kinds=None):
    rng = random.Random(seed)
    model = OneByOne(rng)
    edits = []
    while len(edits) < n:
        e = model.random_edit(rng, len(edits) + 1)
        if e:
            edits.append(e)
    return model, edits


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_one_by_one(spark, seed):
    model, edits = random_log(seed)
    graph, touched, rejected = apply_edits(tables(spark, model.base), log(spark, edits))
    got, want = seen(graph), wanted(model)
    for part in ("owner", "syn", "links"):
        assert got[part] == want[part], part
    assert got["body"] == want["body"]


def test_derived_tables_of_touched_bodies(spark):
    model, edits = random_log(7, 15)
    base = tables(spark, model.base)
    graph, touched, _ = apply_edits(base, log(spark, edits))
    part, full = refresh(derive(base), graph, touched), derive(graph)
    for name in full:
        rows = lambda df: sorted(str(sorted((k, sorted(v.items()) if isinstance(v, dict) else v) for k, v in r.asDict().items())) for r in df.collect())
        assert rows(part[name]) == rows(full[name]), name


def test_edits_that_must_not_hold(spark):
    base = tables(spark, OneByOne(random.Random(0)).base)
    owner = {r.syn_id: r.body_id for r in base["membership"].collect()}
    owned = next(i for i in owner if i % 3 == 0)  # a pre
    mine = [i for i in owner if owner[i] == owner[owned]]
    other = next(i for i in owner if owner[i] != owner[owned])
    edits = [
        {"seq": 1, "kind": "add_link", "syn_id": 21, "post_id": 999}, {"seq": 2, "kind": "add_link", "syn_id": owned, "post_id": 7}, {"seq": 3, "kind": "add_link", "syn_id": 7, "post_id": 21},
        {"seq": 4, "kind": "merge", "bodies": [1, 777]}, {"seq": 5, "kind": "add_neuron", "body_id": 500, "synapses": [other], "props": {}}, {"seq": 6, "kind": "add_neuron", "body_id": 501, "synapses": [888], "props": {}},
        {"seq": 7, "kind": "split", "body_id": owner[owned], "bodies": [502], "synapses": [other]}, {"seq": 8, "kind": "add_synapse", "syn_id": 300, "type": "pre", "x": 5, "y": 0, "z": 0},
        {"seq": 9, "kind": "add_synapse_to_segment", "syn_id": 300, "body_id": 1}, {"seq": 10, "kind": "add_link", "syn_id": 21, "post_id": 14}, {"seq": 11, "kind": "orphan_synapse", "syn_id": owned},
        {"seq": 12, "kind": "add_link", "syn_id": owned, "post_id": 7}, {"seq": 13, "kind": "merge", "bodies": [owner[other], owner[owned]]}, {"seq": 14, "kind": "split", "body_id": owner[other], "bodies": [503], "synapses": [i for i in mine if i != owned][:1]},
        {"seq": 15, "kind": "add_synapse", "syn_id": 301, "type": "pre", "x": 900, "y": 0, "z": 0}, {"seq": 16, "kind": "add_synapse", "syn_id": 302, "type": "pre", "x": 900, "y": 0, "z": 0},
    ]
    graph, _, rejected = apply_edits(base, log(spark, edits))
    assert {r.seq: r.reason for r in rejected.collect()} == {
        1: "unknown synapse", 2: "synapse has an owner", 3: "wrong type of synapse", 4: "unknown body", 5: "synapse has an owner", 6: "unknown synapse", 7: "synapse is not the body's", 8: "place is taken", 9: "unknown synapse", 16: "place is taken"}
    links = {tuple(r) for r in graph["syn_edge"].collect()}
    assert {(21, 14), (owned, 7)} <= links and (21, 999) not in links
    assert {r.body_id for r in graph["membership"].where(F.col("syn_id") == other).collect()} == {owner[other]}


def test_long_merge_lists_and_order(spark):
    """A merge of more than 1,000 bodies right before another one."""
    n = 1200
    bodies = spark.createDataFrame([(b, f"n{b}" if b > n - 3 else None, None, 1, None) for b in range(1, n + 10)], BODY)
    base = tables(spark, OneByOne(random.Random(0)).base) | {"body": bodies}
    graph, _, _ = apply_edits(base, log(spark, [{"seq": 1, "kind": "merge", "bodies": list(range(1, n + 1))}, {"seq": 2, "kind": "merge", "bodies": [n + 1, 1, n + 2]}]))
    got = {r.body_id: (r.name, r.size) for r in graph["body"].collect()}
    assert got[n + 1] == (f"n{n + 1}", n + 2) and len(got) == 8


def test_attributes_follow_the_order_of_edits(spark):
    base = tables(spark, OneByOne(random.Random(0)).base)
    owner = {}
    for r in base["membership"].collect():
        owner.setdefault(r.body_id, []).append(r.syn_id)
    b = max(owner, key=lambda k: len(owner[k]))
    edits = [
        {"seq": 1, "kind": "update_properties", "body_id": b, "props": {"name": "before"}}, {"seq": 2, "kind": "split", "body_id": b, "bodies": [200], "synapses": owner[b][:1]}, {"seq": 3, "kind": "update_properties", "body_id": b, "props": {"name": "after"}},
        {"seq": 4, "kind": "split", "body_id": b, "bodies": [201], "synapses": owner[b][1:2]}, {"seq": 5, "kind": "update_properties", "body_id": 201, "props": {"status": "own"}}, {"seq": 6, "kind": "merge", "bodies": [200, 201]},
    ]
    got = {r.body_id: (r.name, r.status) for r in apply_edits(base, log(spark, edits))[0]["body"].collect()}
    assert got[b] == ("after", None) and got[200] == ("before", "own") and 201 not in got


def test_keys_and_rejects(spark):
    base = tables(spark, OneByOne(random.Random(0)).base)
    edits = [
        {"seq": 1, "kind": "orphan_synapse", "syn_id": 999}, {"seq": 2, "kind": "add_synapse", "syn_id": 1, "type": "pre"}, {"seq": 3, "kind": "split", "body_id": 1, "bodies": [], "synapses": []},
        {"seq": 4, "kind": "delete_neuron", "body_id": 2}, {"seq": 5, "kind": "update_properties", "body_id": 2, "props": {"status": "x"}}, {"seq": 6, "kind": "delete_property", "body_id": 1, "props": {"name": None}},
        {"seq": 7, "kind": "delete_skeleton", "body_id": 1}, {"seq": 8, "kind": "add_skeleton", "body_id": 1, "skeleton": [{"row_no": 1, "x": 5, "y": 5, "z": 5, "parent_row": -1}]},
    ]
    graph, _, rejected = apply_edits(base, log(spark, edits))
    assert {r.seq: r.reason for r in rejected.collect()} == {1: "unknown synapse", 2: "synapse exists", 3: "malformed", 5: "unknown body"}
    assert graph["body"].where("body_id = 1").first().name is None and graph["body"].where("body_id = 2").count() == 0
    assert [r.x for r in graph["skel_node"].collect()] == [5]
    again, touched, _ = apply_edits(graph, log(spark, edits))
    assert touched.count() == 0 and seen(again) == seen(graph)


def test_stream_in_batches_equals_one_batch(spark, tmp_path):
    model, edits = random_log(3, 12)
    base = tables(spark, model.base)
    feed = tmp_path / "feed"
    feed.mkdir()
    save_snapshot(base, str(tmp_path / "graph"), 0)
    for k, part in enumerate((edits[:5], edits[5:])):
        log(spark, part).coalesce(1).write.json(str(tmp_path / f"part{k}"))
        for f in (tmp_path / f"part{k}").glob("*.json"):
            f.rename(feed / f"{k}.json")
        follow(stream_edits(spark, str(feed)), str(tmp_path / "graph"), str(tmp_path / "checkpoint")).awaitTermination()
    last = max(int(p.name[1:]) for p in (tmp_path / "graph").glob("v*"))
    got, want = seen(load_snapshot(spark, str(tmp_path / "graph"), last)), wanted(model)
    assert got["owner"] == want["owner"] and got["links"] == want["links"] and got["syn"] == want["syn"]
    assert read_edits(spark, str(feed)).count() == 12


def test_edits_without_key_always_count(spark, tmp_path):
    base = tables(spark, OneByOne(random.Random(0)).base)
    feed = tmp_path / "feed"
    edits = log(spark, [{"seq": i, "kind": "add_synapse", "syn_id": 400 + i, "type": "pre", "x": 400 + i, "y": 1, "z": 1} for i in range(1, 6)]).withColumn("mutation_key", F.lit(None).cast("string"))
    save_snapshot(base, str(tmp_path / "graph"), 0)
    edits.coalesce(1).write.json(str(feed))
    follow(stream_edits(spark, str(feed)), str(tmp_path / "graph"), str(tmp_path / "checkpoint")).awaitTermination()
    assert load_snapshot(spark, str(tmp_path / "graph"), 1)["synapse"].where("syn_id > 400").count() == 5


def test_stamps_and_repeats(spark):
    old = spark.createDataFrame([(1, "a", datetime(2020, 1, 1)), (2, None, datetime(2020, 1, 1))], "k int, v string, ts timestamp")
    new = spark.createDataFrame([(1, "b", None), (2, None, None), (3, "c", None)], "k int, v string, ts timestamp")
    got = {r.k: r.ts.year for r in stamped(old, new, ["k"], datetime(2024, 5, 5, 1, 2, 3, 999)).collect()}
    assert got == {1: 2024, 2: 2020, 3: 2024}
    rows = spark.createDataFrame([(1, 2, 3)] * 3, "pre_body int, post_body int, syn_id int")
    assert without_repeats(rows).count() == 1
