"""Joins and set operations between synapses, links, bodies and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonweave.functions.columns import composite_id


def with_bodies(synapses: DataFrame, membership: DataFrame) -> DataFrame:
    """Synapses with their body, or null."""
    return synapses.join(membership, "syn_id", "left")


def by_place(membership: DataFrame, synapses: DataFrame) -> DataFrame:
    """Membership given by places (body_id, x, y, z): every synapse at the place, of either type, is the body's."""
    return membership.join(synapses.select("syn_id", "x", "y", "z"), ["x", "y", "z"]).select("body_id", "syn_id")


def resolve_edges(links: DataFrame, synapses: DataFrame) -> DataFrame:
    """links(pre_id, post_id) with the attributes of both ends; links that miss an end are left out."""
    end = lambda s: synapses.select(*(F.col(c).alias(f"{s}_{n}") for c, n in (("syn_id", "id"), ("body_id", "body"), ("confidence", "conf"), ("rois", "rois"), ("x", "x"), ("y", "y"), ("z", "z"))))
    return links.join(end("pre"), "pre_id").join(end("post"), "post_id")


def upsert_endpoints(links: DataFrame, synapses: DataFrame) -> DataFrame:
    """Synapses with those that links name by (type, x, y, z) but the table lacks: confidence 0, no region.
    links: pre and post as structs of x, y, z."""
    ends = links.select(F.inline(F.array(*(F.struct(F.lit(s).alias("type"), F.col(f"{s}.x").alias("x"), F.col(f"{s}.y").alias("y"), F.col(f"{s}.z").alias("z")) for s in ("pre", "post"))))).distinct()
    new = ends.join(synapses, ["type", "x", "y", "z"], "left_anti")
    return synapses.unionByName(new.select("type", "x", "y", "z", F.lit(0.0).alias("confidence"), F.array().cast("array<string>").alias("rois")), allowMissingColumns=True)


def set_keys() -> Column:
    """The two synapse sets of a link, with the synapse each holds."""
    return F.inline(F.array(
        F.struct(F.concat_ws("_", "pre_body", "post_body", F.lit("pre")).alias("set_id"), F.col("pre_body").alias("body_id"), F.col("pre_id").alias("syn_id")),
        F.struct(F.concat_ws("_", "post_body", "pre_body", F.lit("post")).alias("set_id"), F.col("post_body").alias("body_id"), F.col("post_id").alias("syn_id")),
    ))


def synapse_sets(edges: DataFrame) -> DataFrame:
    return edges.select(set_keys()).select("set_id").distinct()


def synapse_set_members(edges: DataFrame) -> DataFrame:
    return edges.select(set_keys()).select("set_id", "syn_id").distinct()


def synapse_set_links(edges: DataFrame) -> DataFrame:
    return edges.select(F.concat_ws("_", "pre_body", "post_body", F.lit("pre")).alias("from_set"), F.concat_ws("_", "post_body", "pre_body", F.lit("post")).alias("to_set")).distinct()


def body_synapse_sets(edges: DataFrame) -> DataFrame:
    return edges.select(set_keys()).select("body_id", "set_id").distinct()


def enrich_bodies(bodies: DataFrame, partners: DataFrame, sizes: DataFrame | None = None, annotations: DataFrame | None = None) -> DataFrame:
    """Bodies with downstream and upstream counts, sizes and annotations; what is missing is 0 or null."""
    rows = bodies.join(partners, "body_id", "left").fillna(0, ["downstream", "upstream"])
    if sizes is not None:
        rows = rows.drop("size").join(sizes, "body_id", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    return rows if annotations is None else rows.join(annotations, "body_id", "left")


def body_sizes(bodies: DataFrame, sizes: DataFrame) -> DataFrame:
    return bodies.select("body_id").join(sizes, "body_id", "left").select("body_id", F.coalesce("size", F.lit(-1)).cast("long").alias("size"))


def dyadic_cover(x0: Column, x1: Column) -> Column:
    """The aligned intervals [cell * 2**level, (cell + 1) * 2**level) that make up x0 to x1 (inclusive), at most two of a
    level, as an array of structs. An interval of a level is taken on the left where its number is odd, on the right where it is
    even and the next begins past the end."""
    levels = F.sequence(F.lit(0), F.floor(F.log2((x1 - x0 + 1).cast("double"))).cast("int") + 1)

    def at(k: Column) -> Column:
        first, end = -F.call_function("shiftright", -x0, k), F.call_function("shiftright", x1 + 1, k)
        left = F.when((first < end) & (first.bitwiseAND(1) == 1), first)
        right = F.when((first < end) & (end.bitwiseAND(1) == 1), end - 1)
        return F.transform(F.array_compact(F.array(left, right)), lambda cell: F.struct(k.alias("level"), cell.alias("cell")))

    return F.when(x0 <= x1, F.flatten(F.transform(levels, at)))


def map_points(points: DataFrame, runs: DataFrame, value: str, scale: int = 0) -> DataFrame:
    """points(x, y, z, ...) with the value of the run that holds them, else null; a row for each run, if several do.
    runs: z, y, x0, x1 (inclusive) and value, in blocks of 2**scale voxels.

    A run is kept as the few aligned cells that it meets, all of one size that follows from its length, and a place probes the
    sizes that occur on its line (z, y) by equality; whether it lies in the run is seen there. Points in one block are one place."""
    length = F.col("_x1") - F.col("_x0") + 1
    cut = runs.select(F.col("z").alias("_z"), F.col("y").alias("_y"), F.col("x0").cast("long").alias("_x0"), F.col("x1").cast("long").alias("_x1"), F.col(value).alias("_value")).where("_x0 <= _x1")
    cut = cut.withColumn("_level", F.greatest(F.floor(F.log2(length.cast("double"))).cast("int") - 2, F.lit(0)))  # a run meets at most nine cells
    lines = cut.groupBy(F.col("_z").alias("_zb"), F.col("_y").alias("_yb")).agg(F.collect_set("_level").alias("_levels"))  # at most 64 a line
    cell = lambda c: F.call_function("shiftright", F.col(c), F.col("_level"))
    cut = cut.withColumn("_cell", F.explode(F.sequence(cell("_x0"), cell("_x1"))))
    blocks = {f"_{c}b": F.shiftright(c, scale) for c in "xyz"}
    at = points.withColumns(blocks)
    places = at.select(*blocks).where("_xb IS NOT NULL AND _yb IS NOT NULL AND _zb IS NOT NULL").distinct()
    probes = places.join(lines, ["_zb", "_yb"]).select(*blocks, F.explode("_levels").alias("_level"))
    probes = probes.withColumn("_cell", F.expr("shiftright(CAST(_xb AS BIGINT), _level)"))
    met = (F.col("_zb") == F.col("_z")) & (F.col("_yb") == F.col("_y")) & (probes["_level"] == cut["_level"]) & (probes["_cell"] == cut["_cell"])
    found = probes.join(cut, met & F.expr("_xb BETWEEN _x0 AND _x1")).select(*blocks, F.col("_value").alias(value))
    return at.join(found, list(blocks), "left").select(*points.columns, value)


def connection_between(conns: DataFrame, pairs: DataFrame) -> DataFrame:
    return conns.join(pairs.select("pre_body", "post_body").distinct(), ["pre_body", "post_body"], "left_semi")


def synapse_connections(edges: DataFrame) -> DataFrame:
    """syn_id, pre_body, post_body: the connections a synapse takes part in."""
    ends = F.explode(F.array("pre_id", "post_id")).alias("syn_id")
    return edges.where("pre_body IS NOT NULL AND post_body IS NOT NULL").select(ends, "pre_body", "post_body").distinct()


def prune_unlinked(connection_synapses: DataFrame, edges: DataFrame) -> DataFrame:
    """Connection synapses that still have a link within the same connection."""
    return connection_synapses.join(synapse_connections(edges), ["pre_body", "post_body", "syn_id"], "left_semi")


def orphans(synapses: DataFrame, membership: DataFrame) -> DataFrame:
    return synapses.join(membership, "syn_id", "left_anti")


def owned(synapses: DataFrame, membership: DataFrame) -> DataFrame:
    return synapses.join(membership, "syn_id", "left_semi")


def lookup(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of df whose keys are listed."""
    return df.join(keys.distinct(), keys.columns, "left_semi")


def parts_of_bodies(bodies: DataFrame, synapses: DataFrame, skel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The synapses and the skeleton nodes of bodies(body_id), which may repeat."""
    wanted = bodies.select("body_id")
    return lookup(synapses, wanted), lookup(skel, wanted)


def all_pairs_once(conns: DataFrame) -> DataFrame:
    """Out and in lists as one set of undirected pairs. A pair is shuffled once, in order, and turned after that."""
    ordered = F.sort_array(F.array("pre_body", "post_body"))
    once = conns.select(F.get(ordered, F.lit(0)).alias("a"), F.get(ordered, F.lit(1)).alias("b")).distinct()
    return once.select(F.inline(F.array_distinct(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))))


def connection_id(dataset: str) -> Column:
    return composite_id(F.lit(dataset), F.col("pre_body"), F.col("post_body"))
