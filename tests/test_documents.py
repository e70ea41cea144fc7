"""Edit documents of every shape, read, told apart, resolved by place and applied."""

import json

from axonweave.plans.edits import apply_edits
from axonweave.schemas import MEMBERSHIP, SKEL_NODE, SYN_EDGE, SYNAPSE
from axonweave.sources.documents import read_edit_documents

BODY = "body_id BIGINT, name STRING, status STRING, size BIGINT, primary_neurite STRING, soma STRUCT<x: BIGINT, y: BIGINT, z: BIGINT, radius: DOUBLE>"
LOG = [
    {"type": "post", "location": [9, 9, 9], "confidence": 0.5, "rois": ["A", "B", "A"]},
    {"id": 50, "size": 12, "mutationUUID": "u1", "name": "new", "soma": {"location": [1, 2, 3], "radius": 4.5}, "currentSynapses": [{"location": [9, 9, 9], "type": "post"}, {"location": [4, 0, 0], "type": "pre"}]},
    {"id": 1, "primaryNeurite": "left", "status": "Traced", "mutationUUID": "u1", "mutationID": 7},
    {"procedure": "deleteName", "bodyId": 1},
    {"procedure": "addRoiToSynapse", "x": 1.0, "y": 0.0, "z": 0.0, "roiName": "C"},
    {"procedure": "removeRoiFromSynapse", "x": 2, "y": 0, "z": 0, "roiName": "A"},
    {"procedure": "orphanSynapse", "x": 3, "y": 0, "z": 0},
    {"procedure": "addSynapseToSegment", "x": 3, "y": 0, "z": 0, "bodyId": 50},
    {"Action": "cleave", "DVIDuuid": "u1", "MutationID": 8, "OrigBodyId": 1, "NewBodyId": 60, "NewBodySynapses": [{"location": [2, 0, 0], "type": "post"}]},
    {"Action": "merge", "DVIDuuid": "u1", "MutationID": 9, "TargetBodyID": 60, "BodiesMerged": [2]},
    {"procedure": "addConnectionBetweenSynapseNodes", "preX": 6, "preY": 0, "preZ": 0, "postX": 7, "postY": 0, "postZ": 0},
    {"procedure": "deleteSynapse", "x": 8, "y": 0, "z": 0},
    {"procedure": "orphanSynapse", "x": 77, "y": 0, "z": 0},  # nothing is there
    {"procedure": "renameEverything"},
    {"id": 70, "currentSynapses": [{"location": [1, 0, 0], "type": "pre"}, {"location": [78, 0, 0], "type": "pre"}]},
    {"note": "no document"},
    {"procedure": "deleteSoma", "bodyId": 2},  # merged before
]


def test_every_shape(spark, tmp_path):
    path = str(tmp_path / "log.json")
    with open(path, "w") as f:
        f.writelines(json.dumps({"seq": i, **d}) + "\n" for i, d in enumerate(LOG))
        f.write("\nnot json\n")
    synapse = [(i, i, 0, 0, "pre" if i in (1, 4, 6) else "post", 1.0, ["A"]) for i in range(1, 9)]
    graph = {
        "synapse": spark.createDataFrame(synapse, SYNAPSE), "syn_edge": spark.createDataFrame([(1, 2), (1, 8)], SYN_EDGE), "membership": spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 5)], MEMBERSHIP),
        "body": spark.createDataFrame([(1, "one", None, 5, None, None), (2, None, "s", 6, None, (0, 0, 0, 1.0))], BODY), "skel_node": spark.createDataFrame([], SKEL_NODE),
    }
    edits = read_edit_documents(spark, path, graph["synapse"])
    rows = {r.seq: r for r in edits.collect()}
    assert len(rows) == len(LOG) + 1 and rows[1].mutation_key == "u1:0" and rows[2].mutation_key == "u1:7" and rows[9].bodies == [60, 2] and rows[4].syn_id == 1
    new = rows[0].syn_id
    assert rows[1].synapses == [new, 4] and rows[0].rois == ["A", "B"] and (rows[10].syn_id, rows[10].post_id) == (6, 7)
    after, _, rejected = apply_edits(graph, edits)
    assert {r.seq: r.reason for r in rejected.collect()} == {12: "malformed", 13: "unknown kind", 14: "malformed", 15: "unknown kind", 16: "unknown body", None: "seq is missing"}
    assert {(r.body_id, r.syn_id) for r in after["membership"].collect()} == {(1, 1), (60, 2), (50, 3), (50, 4), (60, 5), (50, new)}
    assert {r.syn_id: r.rois for r in after["synapse"].collect()} == {1: ["A", "C"], 2: [], 3: ["A"], 4: ["A"], 5: ["A"], 6: ["A"], 7: ["A"], new: ["A", "B"]}
    body = {r.body_id: r for r in after["body"].collect()}
    assert set(body) == {1, 50, 60} and (body[1].name, body[1].status, body[1].primary_neurite) == (None, "Traced", "left")
    assert tuple(body[50].soma) == (1, 2, 3, 4.5) and body[50].size == 12 and body[60].primary_neurite == "left" and tuple(body[60].soma) == (0, 0, 0, 1.0)
    assert {tuple(r) for r in after["syn_edge"].collect()} == {(1, 2), (6, 7)}


def test_equal_lines_and_empty_logs(spark, tmp_path):
    synapse = spark.createDataFrame([(1, 1, 0, 0, "pre", 1.0, ["A"]), (2, 1, 0, 0, "post", 1.0, ["A"])], SYNAPSE)
    path, none = str(tmp_path / "log.json"), str(tmp_path / "none.json")
    with open(path, "w") as f:
        f.write(json.dumps({"seq": 1, "procedure": "deleteSynapse", "x": 1, "y": 0, "z": 0}) + "\n" + json.dumps({"seq": 1, "procedure": "deleteSynapse", "x": 1, "y": 0, "z": 0}) + "\n")
    open(none, "w").close()
    assert [r.syn_id for r in read_edit_documents(spark, path, synapse).collect()] == [1, 1]
    assert read_edit_documents(spark, none, synapse).count() == 0
