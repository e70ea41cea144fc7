"""Edit documents: records of several shapes in one log, told apart and made edits.

A line is a JSON object with seq and ts and either the name and arguments of a procedure, or a document: a body with its
synapses (added), a body without (its attributes), a synapse, or an action of a body log (merge, cleave, split). Synapses
are named by place there; places become ids by a join with the synapses of the graph.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from axonweave.functions.columns import known_rois
from axonweave.operators.graph import checkpointed
from axonweave.schemas import ACTION_DOCUMENT, EDIT, EDIT_DOCUMENT

#: Attributes of documents and their columns.
ATTRIBUTES = {
    "status": "status", "name": "name", "type": "type", "instance": "instance", "primaryNeurite": "primary_neurite", "majorInput": "major_input", "majorOutput": "major_output",
    "clonalUnit": "clonal_unit", "neurotransmitter": "neurotransmitter", "property": "property", "size": "size",
}
#: Procedures and the kinds of edits that they are.
PROCEDURES = {
    "updateProperties": "update_properties", "addNeuron": "add_neuron", "deleteNeuron": "delete_neuron", "deleteSkeleton": "delete_skeleton", "addRoiToSynapse": "add_roi",
    "removeRoiFromSynapse": "remove_roi", "addSynapse": "add_synapse", "addConnectionBetweenSynapseNodes": "add_link", "deleteSynapse": "delete_synapse", "orphanSynapse": "orphan_synapse",
    "addSynapseToSegment": "add_synapse_to_segment",
}
#: Procedures that delete one attribute.
DELETIONS = {f"delete{name[0].upper()}{name[1:]}": column for name, column in (ATTRIBUTES | {"soma": "soma"}).items() if name != "size"}
_ON_PLACE = ("add_roi", "remove_roi", "delete_synapse", "orphan_synapse", "add_synapse_to_segment", "add_synapse")


def _at(c: str | Column, kind: Column) -> Column:
    """A place with the type that is asked of it, from a list of coordinates."""
    return F.struct(*(F.get(c, F.lit(i)).cast("long").alias(n) for i, n in enumerate("xyz")), kind.alias("type"))


def _kind() -> Column:
    by_name = reduce(lambda rest, p: F.when(F.col("d.procedure") == p[0], p[1]).otherwise(rest), PROCEDURES.items(), F.when(F.col("d.procedure").isin(*DELETIONS), "delete_property").otherwise(F.col("d.procedure")))
    action = F.when(F.col("a.Action") == "merge", "merge").when((F.col("a.Action") == "cleave") | F.startswith("a.Action", F.lit("split")), "split").otherwise(F.col("a.Action"))
    shape = F.when(F.col("d.id").isNotNull(), F.when(F.col("d.currentSynapses").isNotNull(), "add_neuron").otherwise("update_properties")).when(F.col("d.location").isNotNull(), "add_synapse")
    return F.when(F.col("d.procedure").isNotNull(), by_name).when(F.col("a.Action").isNotNull(), action).otherwise(shape)


def _props() -> Column:
    """Attributes that a document gives, as text; a soma as JSON. A deletion names its attribute with null."""
    soma = F.when(F.col("d.soma.location").isNotNull(), F.to_json(F.struct(*(F.get("d.soma.location", F.lit(i)).alias(n) for i, n in enumerate("xyz")), F.col("d.soma.radius").alias("radius"))))
    pairs = [F.struct(F.lit(column).alias("k"), F.col(f"d.{name}").cast("string").alias("v")) for name, column in ATTRIBUTES.items()]
    given = F.map_from_entries(F.filter(F.array(*pairs, F.struct(F.lit("soma").alias("k"), soma.alias("v"))), lambda p: p["v"].isNotNull()))
    gone = reduce(lambda rest, p: F.when(F.col("d.procedure") == p[0], F.create_map(F.lit(p[1]), F.lit(None).cast("string"))).otherwise(rest), DELETIONS.items(), F.lit(None).cast("map<string,string>"))
    return F.when(F.col("kind").isin("add_neuron", "update_properties"), given).otherwise(gone)


def edit_documents(lines: DataFrame, synapses: DataFrame) -> DataFrame:
    """lines(value) -> edits, one of each line; synapses(syn_id, x, y, z, type) are those of the graph.

    mutation_key is the uuid with the mutation id, which is 0 if it is missing; without a uuid it is null. A synapse that is
    added gets an id from its place and type, by which later lines may name it. A place of two synapses without a type
    asked stands for the smaller id. A place that nothing is at, and a line that is no document, give an edit without the
    argument or kind, which `formed` rejects with its reason. Equal lines stay as many edits. Skeletons come from their
    own files (`read_skeletons`); names and status that a merge gives its target are edits of their own.
    """
    rows = lines.select(F.monotonically_increasing_id().alias("_id"), F.from_json("value", EDIT_DOCUMENT).alias("d"), F.from_json("value", ACTION_DOCUMENT).alias("a")).withColumn("kind", _kind())  # stored below, so ids stay
    any_type, here = F.lit(None).cast("string"), F.coalesce("d.location", F.array("d.x", "d.y", "d.z"))
    rows = rows.select(
        "_id", "d.seq", "d.ts", "kind",
        F.concat_ws(":", F.coalesce("d.mutationUUID", "a.DVIDuuid"), F.coalesce("d.mutationID", "a.MutationID", F.lit(0))).alias("mutation_key"),
        F.coalesce("d.mutationUUID", "a.DVIDuuid").isNotNull().alias("_keyed"),
        F.coalesce("d.bodyId", "d.id", "a.OrigBodyId").alias("body_id"),
        F.when(F.col("kind") == "merge", F.concat(F.array("a.TargetBodyID"), F.array_sort(F.array_distinct(F.col("a.BodiesMerged"))))).when(F.col("kind") == "split", F.array("a.NewBodyId")).alias("bodies"),
        F.when(F.col("kind") == "add_synapse", F.col("d.type")).alias("type"), F.when(F.col("kind") == "add_synapse", F.coalesce("d.confidence", F.lit(0.0))).alias("confidence"),
        F.col("d.roiName").alias("roi"), F.when(F.col("kind") == "add_synapse", known_rois(F.coalesce("d.rois", F.array().cast("array<string>")))).alias("rois"), _props().alias("props"),
        F.when(F.col("kind").isin(*_ON_PLACE), _at(here, F.when(F.col("kind") == "add_synapse", F.col("d.type")).otherwise(any_type)))
        .when(F.col("kind") == "add_link", _at(F.array("d.preX", "d.preY", "d.preZ"), F.lit("pre"))).alias("_at"),
        F.when(F.col("kind") == "add_link", _at(F.array("d.postX", "d.postY", "d.postZ"), F.lit("post"))).alias("_post"),
        F.when(F.col("kind").isin("add_neuron", "split"), F.transform(F.coalesce("d.currentSynapses", "a.NewBodySynapses", F.array().cast("array<struct<location:array<double>,type:string>>")), lambda s: _at(s["location"], s["type"]))).alias("_own"),
    ).withColumn("mutation_key", F.when(F.col("_keyed"), F.col("mutation_key")))
    rows = checkpointed(rows)  # four steps read them; lines are parsed once, where they are read
    new = rows.where("kind = 'add_synapse'").select("_at.*").where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AND type IN ('pre', 'post')").distinct()
    new = new.withColumn("syn_id", F.shiftrightunsigned(F.xxhash64("type", "x", "y", "z"), 2))
    asked = F.concat(
        F.array(F.struct(F.lit("_syn").alias("role"), F.lit(0).alias("place"), F.when(F.col("kind") != "add_synapse", F.col("_at")).alias("p"))), F.array(F.struct(F.lit("_end").alias("role"), F.lit(0).alias("place"), F.col("_post").alias("p"))),
        F.coalesce(F.transform("_own", lambda p, i: F.struct(F.lit("_many").alias("role"), i.alias("place"), p.alias("p"))), F.array().cast("array<struct<role:string,place:int,p:struct<x:bigint,y:bigint,z:bigint,type:string>>>")),
    )
    asks = rows.select("_id", F.inline(asked)).where("p IS NOT NULL").select("_id", "role", "place", "p.x", "p.y", "p.z", F.col("p.type").alias("want"))
    known = synapses.select("syn_id", "x", "y", "z", "type").withColumn("old", F.lit(0)).unionByName(new.withColumn("old", F.lit(1)))
    # few asks are sent to the synapses; an ask of a list is a row without what is at its place too, so one that meets nothing stays
    at = asks.join(known, ["x", "y", "z"]).where("want IS NULL OR want = type").select("_id", "role", "place", F.struct("old", "syn_id").alias("m"))
    met = at.unionByName(asks.where("role = '_many'").select("_id", "role", "place"), allowMissingColumns=True).repartition("_id").groupBy("_id", "role", "place").agg(F.min("m").alias("m"))
    found = met.groupBy("_id").agg(
        F.max(F.when(F.col("role") == "_syn", F.col("m.syn_id"))).alias("_syn"), F.max(F.when(F.col("role") == "_end", F.col("m.syn_id"))).alias("_end"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "_many", F.struct("place", F.col("m.syn_id").alias("id"))))), lambda s: s["id"]).alias("_many"),
    )
    added, position = F.col("kind") == "add_synapse", lambda n: F.when(F.col("kind") == "add_synapse", F.col(f"_at.{n}")).alias(n)
    out = rows.join(found, "_id", "left").select(
        "seq", "ts", "mutation_key", "kind", "body_id", "bodies",
        F.when(added, F.when(F.expr("_at.x IS NOT NULL AND _at.y IS NOT NULL AND _at.z IS NOT NULL"), F.shiftrightunsigned(F.xxhash64("type", "_at.x", "_at.y", "_at.z"), 2))).otherwise(F.col("_syn")).alias("syn_id"),
        F.col("_end").alias("post_id"), *(position(n) for n in "xyz"), "type", "confidence", "roi", "rois", F.when(F.col("kind").isin("add_neuron", "split"), F.coalesce("_many", F.array().cast("array<bigint>"))).alias("synapses"), "props",
    )
    schema = StructType.fromDDL(EDIT)
    return out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def read_edit_documents(spark: SparkSession, path: str, synapses: DataFrame) -> DataFrame:
    """The edits of a log with one document a line."""
    return edit_documents(spark.read.text(path).where("trim(value) <> ''"), synapses)
