"""Writers: the graph as Parquet by dataset, and CSV files with typed headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonweave.functions.columns import roi_flag, roi_json


def write_graph(tables: dict[str, DataFrame], path: str, dataset: str, mode: str = "append") -> None:
    """One folder per table, partitioned by dataset; rows are clustered by their first column, so that lookups by
    it skip files."""
    for name, df in tables.items():
        df.withColumn("dataset", F.lit(dataset)).repartitionByRange(df.columns[0]).sortWithinPartitions(df.columns[0]).write.mode(mode).partitionBy("dataset").parquet(f"{path}/{name}")


def _csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    df.write.option("header", header).option("escape", '"').option("sep", sep).csv(path)


def synapses_form(synapses: DataFrame, dataset: str, rois: list[str]) -> DataFrame:
    """Synapses with a typed header, a flag per region and their labels."""
    kind = F.when(F.col("type") == "pre", "PreSyn").otherwise("PostSyn")
    return synapses.select(
        F.col("syn_id").alias(":ID(Syn-ID)"), F.col("type").alias("type:string"), F.col("confidence").alias("confidence:float"),
        F.format_string("{x:%d, y:%d, z:%d}", "x", "y", "z").alias("location:point{srid:9157}"), *(roi_flag(F.col("rois"), r).alias(f"{r}:boolean") for r in rois),
        F.concat_ws(";", F.lit("Synapse"), kind, F.lit(f"{dataset}_Synapse"), F.concat(F.lit(f"{dataset}_"), kind)).alias(":LABEL"),
    )


def bodies_form(bodies: DataFrame, dataset: str, rois: list[str]) -> DataFrame:
    """Bodies (body_id, pre, post, roi_info, is_neuron and attributes) with a typed header and a flag per region."""
    label = F.concat_ws(";", F.lit("Segment"), F.lit(f"{dataset}_Segment"), F.when(F.col("is_neuron"), F.lit(f"Neuron;{dataset}_Neuron")))
    known = {"pre": "int", "post": "int", "upstream": "int", "downstream": "int", "status": "string", "statusLabel": "string", "cropped": "boolean", "instance": "string", "notes": "string", "type": "string", "size": "long"}
    return bodies.select(
        F.col("body_id").alias(":ID(Body-ID)"), F.col("body_id").alias("bodyId:long"), *(F.col(c).alias(f"{c}:{t}") for c, t in known.items() if c in bodies.columns),
        roi_json(F.col("roi_info")).alias("roiInfo:string"), label.alias(":LABEL"), *(roi_flag(F.map_keys("roi_info"), r).alias(f"{r}:boolean") for r in rois),
    )


def connections_form(conns: DataFrame) -> DataFrame:
    """Connections (pre_body, post_body, weight, weight_hp, roi_info)."""
    return conns.select(F.col("pre_body").alias(":START_ID(Body-ID)"), F.col("weight").alias("weight:int"), F.col("weight_hp").alias("weightHP:int"), F.col("post_body").alias(":END_ID(Body-ID)"), F.to_json("roi_info").alias("roiInfo:string"))


def write_synapses_csv(synapses: DataFrame, path: str, dataset: str, rois: list[str]) -> None:
    _csv(synapses_form(synapses, dataset, rois), path)


def write_bodies_csv(bodies: DataFrame, path: str, dataset: str, rois: list[str]) -> None:
    _csv(bodies_form(bodies, dataset, rois), path)


def write_connections_csv(conns: DataFrame, path: str) -> None:
    _csv(connections_form(conns), path)


def write_syn_edges_csv(links: DataFrame, path: str) -> None:
    _csv(links.select(F.col("pre_id").alias(":START_ID(Syn-ID)"), F.col("post_id").alias(":END_ID(Syn-ID)")), path)


def write_synapse_sets_csv(sets: DataFrame, path: str, dataset: str) -> None:
    _csv(sets.select(F.col("set_id").alias(":ID(SynSet-ID)"), F.lit(f"SynapseSet;{dataset}_SynapseSet").alias(":LABEL")), path)


def write_set_members_csv(members: DataFrame, path: str) -> None:
    _csv(members.select(F.col("set_id").alias(":START_ID"), F.col("syn_id").alias(":END_ID(Syn-ID)")), path)


def write_set_links_csv(links: DataFrame, path: str) -> None:
    _csv(links.select(F.col("from_set").alias(":START_ID"), F.col("to_set").alias(":END_ID")), path)


def write_body_sets_csv(pairs: DataFrame, path: str) -> None:
    _csv(pairs.orderBy("body_id", "set_id").select(F.col("body_id").alias(":START_ID(Body-ID)"), F.col("set_id").alias(":END_ID(SynSet-ID)")), path)


def write_body_rois_csv(by_roi: DataFrame, path: str) -> None:
    _csv(by_roi.select(F.col("body_id").alias(":START_ID(Body-ID)"), F.col("pre").alias("pre:int"), F.col("post").alias("post:int"), F.col("roi").alias(":END_ID(ROI-ID)")), path)


def write_set_rois_csv(counts: DataFrame, path: str) -> None:
    _csv(counts.select(F.col("set_id").alias(":START_ID"), F.col("weight").alias("weight:int"), F.col("weight_hp").alias("weightHP:int"), F.col("roi").alias(":END_ID(ROI-ID)")), path)


#: Columns of the meta file and their types, in order.
META_COLUMNS = (
    "voxelSize:float[]", "voxelUnits:string", "info:string", "logo:string", "postHighAccuracyThreshold:float", "preHPThreshold:float", "postHPThreshold:float", "meshHost:string", "uuid:string",
    "neuroglancerInfo:string", "neuroglancerMeta:string", "statusDefinitions:string", "latestMutationId:int", "totalPreCount:int", "totalPostCount:int", "lastDatabaseEdit:string", "superLevelRois:string[]",
    "primaryRois:string[]", "nonHierarchicalROIs:string[]", "roiInfo:string", "roiHierarchy:string", "dataset:string", ":LABEL",
)


def meta_form(meta: DataFrame, roi_counts: DataFrame, dataset: str, super_rois: DataFrame, descriptions: DataFrame | None = None, other_rois: DataFrame | None = None, hierarchy: str | None = None, **fixed) -> DataFrame:
    """The dataset's row with the columns of the meta file.

    meta: total_pre and total_post; roi_counts: roi, pre, post, the dataset's own name for the totals; descriptions:
    roi, description, of the regions to be listed (all, if not given); super_rois and other_rois: roi. fixed gives
    further columns by name, without type; what is not given is empty. Regions number in the hundreds, so their
    lists are one row.
    """
    listed = roi_counts if descriptions is None else descriptions.join(roi_counts, "roi", "left")
    entry = F.struct(*([] if descriptions is None else ["description"]), "pre", "post")
    info = listed.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("roi").alias("key"), entry.alias("value")))))).alias("roiInfo"))
    names = lambda df, c: df.agg(F.array_join(F.sort_array(F.collect_set("roi")), ";").alias(c))
    rows = meta.crossJoin(F.broadcast(info)).crossJoin(F.broadcast(names(super_rois, "superLevelRois")))
    rows = rows.crossJoin(F.broadcast(names(other_rois, "nonHierarchicalROIs"))) if other_rois is not None else rows.withColumn("nonHierarchicalROIs", F.lit(""))
    found = {"totalPreCount": F.col("total_pre"), "totalPostCount": F.col("total_post"), "primaryRois": F.col("superLevelRois"), "roiHierarchy": F.lit(hierarchy).cast("string"), "dataset": F.lit(dataset), "": F.lit(f"Meta;{dataset}_Meta")}
    found |= {c: F.col(c) for c in ("superLevelRois", "nonHierarchicalROIs", "roiInfo")} | {k: F.lit(v) for k, v in fixed.items()}
    return rows.select(*(found.get(c.partition(":")[0], F.lit(None).cast("string")).alias(c) for c in META_COLUMNS))


def write_meta_csv(meta: DataFrame, path: str) -> None:
    """meta as meta_form gives it."""
    _csv(meta.select(*META_COLUMNS), path)


def write_resolved_edges_csv(edges: DataFrame, path: str) -> None:
    """Links with both ends, sorted by the body of the pre end over all files."""
    side = lambda s, n: [F.col(f"{s}_{c}").alias(f"{n}_{t}") for c, t in (("id", "synId"), ("x", "x"), ("y", "y"), ("z", "z"), ("conf", "conf"))] + [F.array_join(f"{s}_rois", ";").alias(f"{n}_rois"), F.col(f"{s}_body").alias(f"{n}_bodyId")]
    rows = edges.select(*side("pre", "from"), F.lit("PreSynTo").alias("connection"), *side("post", "to"))
    _csv(rows.repartitionByRange("from_bodyId").sortWithinPartitions("from_bodyId", "from_synId", "to_synId"), path)


def write_body_counts(bodies: DataFrame, path: str) -> None:
    """body_id;pre;post;region counts as JSON, without header or quotes."""
    line = F.concat_ws(";", F.col("body_id").cast("string"), F.col("pre").cast("string"), F.col("post").cast("string"), roi_json(F.col("roi_info")))
    bodies.select(line.alias("value")).write.text(path)


def write_body_ids(bodies: DataFrame, path: str) -> None:
    bodies.select(F.col("body_id").cast("string")).distinct().write.text(path)


def as_json_text(df: DataFrame, key: str) -> DataFrame:
    """Rows as one JSON text per key, where a client wants text."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.to_json(F.sort_array(F.collect_list(F.struct(*rest)))).alias("json"))
