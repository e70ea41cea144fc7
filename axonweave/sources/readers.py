"""Readers: files to canonical tables, with explicit schemas and no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from axonweave.functions.columns import half_up, known_rois, roi_from_json, roi_list, roi_name, swc_body_id, swc_uuid, synapse_type
from axonweave.operators.rank import numbered
from axonweave.schemas import BODY_JSON, EDGE_JSON, EDIT, FIRST_SYNAPSE_ID, MAPPED_CSV, META_JSON, RELS_JSON, SYNAPSE_CSV, SYNAPSE_JSON


def _json(spark: SparkSession, path: str, schema: str, lines: bool) -> DataFrame:
    """A JSON array per file, or one object per line, which large files should have: only lines can be split."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def _place(c: str) -> list[Column]:
    return [F.get(c, F.lit(i)).cast("long").alias(n) for i, n in enumerate("xyz")]


def raw_synapses(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return _json(spark, path, SYNAPSE_JSON, lines)


def read_synapses(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """type, x, y, z, confidence (0 if missing), rois in listed order without those that are ignored."""
    rows = raw_synapses(spark, path, lines)
    return rows.select("type", *_place("location"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), known_rois(F.coalesce("rois", F.array().cast("array<string>"))).alias("rois"))


def read_syn_edges(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    rows = _json(spark, path, EDGE_JSON, lines)
    return rows.select(F.struct(*_place("pre")).alias("pre"), F.struct(*_place("post")).alias("post"))


def read_bodies(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Bodies, and their membership by places (body_id, x, y, z). An empty soma is none."""
    rows = _json(spark, path, BODY_JSON, lines).withColumn("body_id", F.col("id").cast("long"))
    soma = F.when(F.col("soma.location").isNotNull(), F.struct(*(F.get("soma.location", F.lit(i)).alias(n) for i, n in enumerate("xyz")), F.col("soma.radius").alias("radius")))
    names = {"primaryNeurite": "primary_neurite", "majorInput": "major_input", "majorOutput": "major_output", "clonalUnit": "clonal_unit"}
    bodies = rows.withColumnsRenamed(names).select("body_id", "name", "type", "instance", *names.values(), "neurotransmitter", "property", "status", "size", soma.alias("soma"), known_rois(F.coalesce("rois", F.array().cast("array<string>"))).alias("rois"))
    return bodies, rows.select("body_id", F.explode("synapseSet").alias("p")).select("body_id", *_place("p"))


def read_skeletons(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of all swc files under path: body_id from the file's name, whole coordinates, rows as in the file."""
    lines = spark.read.text(path).select(swc_body_id(F.col("_metadata.file_path")).alias("body_id"), F.trim("value").alias("line")).where("line <> '' AND NOT startswith(line, '#')")
    part = F.split("line", r"\s+")
    at = lambda i, t: F.get(part, F.lit(i)).try_cast(t)
    return lines.select("body_id", at(0, "int").alias("row_no"), at(1, "int").alias("type"), *(half_up(at(2 + i, "double")).alias(c) for i, c in enumerate("xyz")), at(5, "double").alias("radius"), at(6, "int").alias("parent_row"))


def skeleton_mutations(spark: SparkSession, path: str) -> DataFrame:
    """body_id, mutation_id (the number in a file's header, if there is one) and uuid (that in its path, else `none`)."""
    head = spark.read.text(path).select(swc_body_id(F.col("_metadata.file_path")).alias("body_id"), swc_uuid(F.col("_metadata.file_path")).alias("uuid"), F.when(F.startswith("value", F.lit("#")) & F.lower("value").contains("mutation"), F.regexp_replace("value", "[^0-9]", "")).alias("m"))
    return head.groupBy("body_id").agg(F.max(F.nullif("m", F.lit("")).try_cast("long")).alias("mutation_id"), F.max("uuid").alias("uuid"))


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, META_JSON, False)


def read_synapse_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SYNAPSE_CSV).option("header", True).csv(path).select("x", "y", "z", synapse_type(F.col("kind")).alias("type"), F.col("conf").alias("confidence"))


def read_mapped_synapses(spark: SparkSession, path: str) -> DataFrame:
    """Synapses with up to four levels of regions and their body; those of body 0 are dropped."""
    rows = spark.read.schema(MAPPED_CSV).option("header", True).csv(path)
    levels = [roi_name(F.nullif(F.col(c), F.lit("<unspecified>"))) for c in ("super_roi", "sub1_roi", "sub2_roi", "sub3_roi")]
    return rows.where("body_id <> 0").select("syn_id", "x", "y", "z", synapse_type(F.col("type")).alias("type"), "confidence", roi_list(*levels).alias("rois"), "body_id")


def with_synapse_ids(synapses: DataFrame) -> DataFrame:
    """Ids from the first synapse id on, by place and type, so that reruns give equal ids."""
    return numbered(synapses, ["x", "y", "z", "type"], FIRST_SYNAPSE_ID)


def read_synapse_rels(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Links as places (pre, post) from nested synapses: a pre says which posts it goes to, once each."""
    rows = _json(spark, path, RELS_JSON, lines).where("Kind = 'PreSyn'").select(F.struct(*_place("Pos")).alias("pre"), F.explode("Rels").alias("r")).where("r.Rel = 'PreSynTo'")
    return rows.select("pre", F.struct(*_place("r.To")).alias("post")).distinct()


def read_body_counts(spark: SparkSession, path: str) -> DataFrame:
    """body_id;pre;post;region counts as JSON."""
    rows = spark.read.schema("body_id BIGINT, pre BIGINT, post BIGINT, roi_info STRING").option("sep", ";").option("quote", "").csv(path)
    return rows.where("body_id IS NOT NULL").withColumn("roi_info", roi_from_json(F.col("roi_info")))


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("body_id BIGINT, size BIGINT").option("header", True).csv(path)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line with `body ID` and free attributes."""
    fields = ("status", "name", "instance", "class", "primary neurite", "major input", "major output", "neurotransmitter", "clonal unit", "synonym")
    rows = spark.read.schema(", ".join(["`body ID` BIGINT", *(f"`{f}` STRING" for f in fields)])).json(path)
    return rows.select(F.col("body ID").alias("body_id"), *(F.col(f"`{f}`").alias(f.replace(" ", "_")) for f in fields))


def read_roi_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''").distinct()


def read_roi_names(spark: SparkSession, path: str) -> DataFrame:
    """name, position of a JSON list of regions, as the lists of top-level and of non-hierarchical regions are; one small file."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>")).alias("position", "name"))
    return rows.where("trim(name) <> ''").select(F.trim("name").alias("name"), "position")


def with_top_levels(tree: DataFrame, tops: DataFrame, apart: DataFrame) -> DataFrame:
    """Regions of a tree (name, parent, level) and of the two lists with is_top and is_apart (in no hierarchy). Regions that only a
    list names come without parent and level."""
    flags = tops.select("name", F.lit(True).alias("is_top"), F.lit(False).alias("is_apart")).unionByName(apart.select("name", F.lit(False).alias("is_top"), F.lit(True).alias("is_apart")))
    flags = flags.groupBy("name").agg(F.max("is_top").alias("is_top"), F.max("is_apart").alias("is_apart"))
    return tree.join(flags, "name", "full_outer").select("name", "parent", "level", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("is_top", "is_apart")))


def read_roi_tree(spark: SparkSession, path: str, depth: int = 8) -> DataFrame:
    """name, parent, level of a nested JSON tree of names and children; one with more than depth levels is an error."""
    kind = "STRUCT<name: STRING>"
    for _ in range(depth):  # a level more, to see whether the last one has children
        kind = f"STRUCT<name: STRING, children: ARRAY<{kind}>>"
    level = spark.read.schema(kind.removeprefix("STRUCT<").removesuffix(">").replace("name: STRING, children: ", "name STRING, children ", 1)).option("multiLine", True).json(path)
    out, parent = None, F.lit(None).cast("string")
    for k in range(depth):
        rows = level.select("name", parent.alias("parent"), F.lit(k).alias("level"))
        out = rows if out is None else out.union(rows)
        if k < depth - 1:
            level = level.select(F.col("name").alias("_parent"), F.inline("children"))
            parent = F.col("_parent")
    if not level.where(F.size("children") > 0).isEmpty():
        raise ValueError(f"{path} has more than {depth} levels of regions")
    return out.where("name IS NOT NULL")


def read_edits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EDIT).json(path)


def stream_edits(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EDIT).json(path)


def read_graph_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One table of a bundle of CSV files with typed headers; the schema says what the header does."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


#: Types in headers of the import format, and what stands for fields without a name.
HEADER_TYPES = {"int": "INT", "long": "BIGINT", "float": "DOUBLE", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "STRING"}
HEADER_FIELDS = {"ID": "id", "START_ID": "start_id", "END_ID": "end_id", "LABEL": "label", "TYPE": "type"}


def typed_field(header: str) -> str:
    """A column of a typed header (name:type, :ID(space), :LABEL ...) as name and type. Ids, points, labels and
    lists stay text, as an id space may hold any text."""
    name, _, kind = header.partition(":")
    plain = kind.split("(")[0].split("{")[0]
    return f"`{name or HEADER_FIELDS.get(plain, plain.lower())}` {HEADER_TYPES.get(plain, 'STRING')}"


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, or folder of files, with one typed header."""
    names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    return read_graph_csv(spark, path, ", ".join(map(typed_field, names)))


def read_typed_bundle(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The tables of a bundle of CSV files with typed headers, by name."""
    return {name: read_typed_csv(spark, path) for name, path in paths.items()}


def described(meta: DataFrame, description: DataFrame) -> DataFrame:
    """Derived counts of a dataset (one row) with what read_meta says of it (one row)."""
    return meta.crossJoin(F.broadcast(description.limit(1)))
