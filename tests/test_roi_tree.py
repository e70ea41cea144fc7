"""Depth of region trees."""

import json

import pytest

from axonweave.operators import aggregate as A
from axonweave.sources import readers


def test_deep_region_tree(spark, tmp_path):
    tree = {"name": "r9"}
    for k in range(8, 0, -1):
        tree = {"name": f"r{k}", "children": [tree]}
    path = tmp_path / "tree.json"
    path.write_text(json.dumps(tree))
    with pytest.raises(ValueError, match="more than 8 levels"):
        readers.read_roi_tree(spark, str(path))
    rows = sorted(map(tuple, readers.read_roi_tree(spark, str(path), 9).collect()))
    assert rows == [(f"r{k}", f"r{k - 1}" if k > 1 else None, k - 1) for k in range(1, 10)]


def test_two_loads_equal_one(spark):
    rows = [(1, "pre", ["A", "a1"]), (2, "post", ["A"]), (3, "post", []), (4, "pre", ["B", "A"]), (5, "post", ["C"])]
    every = spark.createDataFrame(rows, "syn_id long, type string, rois array<string>")
    rois = spark.createDataFrame([("A",), ("B",), ("never",), ("all",)], "name string")
    parts = [A.load_summary(every.where(w)) for w in ("syn_id < 3", "syn_id >= 3", "false")]
    totals, by_roi, supers = A.meta_of_summary(A.merged_summaries(*parts), rois, "all")
    assert totals.collect() == A.meta_totals(every).collect()
    assert sorted(by_roi.collect()) == sorted(A.meta_roi(every, rois, "all").collect())
    assert sorted(supers.collect()) == sorted(A.super_level_rois(every).collect())


def test_lists_of_regions(spark, tmp_path):
    (tmp_path / "tops.json").write_text(json.dumps(["A", " B ", ""], indent=1))
    (tmp_path / "apart.json").write_text(json.dumps(["X"]))
    tops, apart = (readers.read_roi_names(spark, str(tmp_path / f"{n}.json")) for n in ("tops", "apart"))
    tree = spark.createDataFrame([("A", None, 0), ("a1", "A", 1)], "name string, parent string, level int")
    got = {tuple(r) for r in readers.with_top_levels(tree, tops, apart).collect()}
    assert got == {("A", None, 0, True, False), ("a1", "A", 1, False, False), ("B", None, None, True, False), ("X", None, None, False, True)}


def test_version_of_a_skeleton(spark, tmp_path):
    folder = tmp_path / "api" / "node" / "a1b2" / "segmentation"
    folder.mkdir(parents=True)
    (folder / "17_swc").write_text('# {"mutation id": 5}\n1 0 1 1 1 1 -1\n')
    (tmp_path / "18.swc").write_text("1 0 1 1 1 1 -1\n")
    assert tuple(readers.skeleton_mutations(spark, str(folder)).first()) == (17, 5, "a1b2")
    assert tuple(readers.skeleton_mutations(spark, str(tmp_path / "18.swc")).first()) == (18, None, "none")
