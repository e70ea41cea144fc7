"""The derived tables of a graph from its base tables, whole or for some bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonweave.functions.columns import cluster_name, composite_id, neuron_by_counts, neuron_by_evidence
from axonweave.operators.aggregate import as_roi_info, body_counts, body_roi_counts, connection_roi, connections, connections_by_roi, meta_roi, meta_totals, super_level_rois
from axonweave.operators.graph import checkpointed
from axonweave.operators.relate import resolve_edges, with_bodies
from axonweave.schemas import EVIDENCE

Graph = dict[str, DataFrame]


def owned_synapses(graph: Graph) -> DataFrame:
    return with_bodies(graph["synapse"], graph["membership"])


def derive(graph: Graph, pre_hp: float = 0.2, post_hp: float = 0.8, threshold: int | None = None, with_regions: bool = True, rois: DataFrame | None = None, dataset: str = "dataset", supers: DataFrame | None = None, **options) -> Graph:
    """body_info (pre, post, roi_info, is_neuron, cluster_name), connection (weights, roi_info), meta and meta_roi.

    Bodies without synapses keep null counts. Neurons are told by evidence, or by counts if a threshold is given.
    with_regions=False leaves out everything by region. supers(roi): the super regions, if not those of the synapses.
    """
    synapses = owned_synapses(graph)
    edges = resolve_edges(graph["syn_edge"], synapses)
    info = graph["body"].join(body_counts(synapses), "body_id", "left")
    conns = connections(edges, pre_hp, post_hp, **options)
    out: Graph = {"meta": meta_totals(synapses).withColumn("dataset", F.lit(dataset))}
    attributes = [a for a in EVIDENCE if a in info.columns]
    neuron = neuron_by_counts(F.col("pre"), F.col("post"), threshold) if threshold is not None else neuron_by_evidence(F.col("pre"), F.col("post"), attributes)
    if with_regions:
        by_roi = body_roi_counts(synapses)
        supers = (super_level_rois(synapses) if supers is None else supers).agg(F.sort_array(F.collect_set("roi")).alias("super_rois"))  # one small row
        info = info.join(as_roi_info(by_roi, ["body_id"]), "body_id", "left").withColumn("is_neuron", neuron)
        info = info.crossJoin(F.broadcast(supers)).withColumn("cluster_name", cluster_name(F.col("is_neuron"), F.col("roi_info"), F.col("pre"), F.col("post"), F.col("super_rois"))).drop("super_rois")
        if options:  # another reading of weights
            regions = as_roi_info(connection_roi(edges, pre_hp, post_hp), ["pre_body", "post_body"], hp=True)
            conns = conns.join(regions, ["pre_body", "post_body"], "left")
        else:
            conns = connections_by_roi(edges, pre_hp, post_hp)
        if rois is not None:
            out["meta_roi"] = meta_roi(synapses, rois, dataset)
    else:
        info = info.withColumn("is_neuron", neuron)
    out["body_info"] = info.withColumn("key", composite_id(F.lit(dataset), F.col("body_id")))
    out["connection"] = conns
    return out


def restricted(graph: Graph, bodies: DataFrame) -> Graph:
    """The part of the base tables that connections of bodies(body_id) and their counts depend on."""
    touched = bodies.select("body_id").distinct()
    member = graph["membership"].join(touched, "body_id", "left_semi").select("syn_id")
    links = graph["syn_edge"].join(member.withColumnRenamed("syn_id", "pre_id"), "pre_id", "left_semi").unionByName(graph["syn_edge"].join(member.withColumnRenamed("syn_id", "post_id"), "post_id", "left_semi")).distinct()
    ids = member.union(links.select("pre_id")).union(links.select("post_id")).distinct()
    return graph | {"syn_edge": links, "synapse": graph["synapse"].join(ids, "syn_id", "left_semi"), "body": graph["body"].join(touched, "body_id", "left_semi")}


def refresh(old: Graph, graph: Graph, touched: DataFrame, **options) -> Graph:
    """Derived tables after a change of the bodies in touched: their connections and counts are computed anew, others
    are kept. Totals, region totals and super regions are those of the whole graph; if the super regions changed,
    all cluster names are made anew from the counts."""
    every = owned_synapses(graph)
    supers = checkpointed(super_level_rois(every))
    new = derive(restricted(graph, touched), **options, supers=supers)
    ids = touched.select("body_id").distinct()
    kept = old["connection"].join(ids.withColumnRenamed("body_id", "pre_body"), "pre_body", "left_anti").join(ids.withColumnRenamed("body_id", "post_body"), "post_body", "left_anti")
    near = ids.withColumnRenamed("body_id", "pre_body"), ids.withColumnRenamed("body_id", "post_body")
    fresh = new["connection"].join(near[0], "pre_body", "left_semi").unionByName(new["connection"].join(near[0], "pre_body", "left_anti").join(near[1], "post_body", "left_semi"))
    info = old["body_info"].join(ids, "body_id", "left_anti").unionByName(new["body_info"], allowMissingColumns=True)
    if "cluster_name" in info.columns:
        names = F.array_sort(F.array(*map(F.lit, (r.roi for r in supers.collect())))).cast("array<string>")  # regions, a few
        info = info.withColumn("cluster_name", cluster_name(F.col("is_neuron"), F.col("roi_info"), F.col("pre"), F.col("post"), names))
    dataset = options.get("dataset", "dataset")
    out = old | {"connection": kept.unionByName(fresh), "body_info": info, "meta": meta_totals(every).withColumn("dataset", F.lit(dataset))}
    if options.get("rois") is not None:
        out["meta_roi"] = meta_roi(every, options["rois"], dataset)
    return out
