"""Ranking: top regions and partners, nearest points, first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from axonweave.functions.columns import squared_distance


def top_roi(by_roi: DataFrame, kind: str = "pre") -> DataFrame:
    """body_id, roi, n: the region with the most pres (outputs) or posts (inputs), ties to the smaller name. An
    aggregation, not a window: it combines before the shuffle."""
    best = by_roi.groupBy("body_id").agg(F.min_by(F.struct("roi", F.col(kind).alias("n")), F.struct((-F.col(kind)).alias("a"), F.col("roi").alias("b"))).alias("m"))
    return best.select("body_id", "m.roi", "m.n")


def neighbors(conns: DataFrame) -> DataFrame:
    """body_id, partner, is_out, weight in both directions."""
    ends = F.inline(F.array(
        F.struct(F.col("pre_body").alias("body_id"), F.col("post_body").alias("partner"), F.lit(True).alias("is_out"), "weight"),
        F.struct(F.col("post_body").alias("body_id"), F.col("pre_body").alias("partner"), F.lit(False).alias("is_out"), "weight"),
    ))
    return conns.select(ends)


def top_partners(conns: DataFrame, x: int) -> DataFrame:
    """The x strongest partners of every body in either direction; ties to the smaller partner, outputs first. A
    partner both ways may stand twice."""
    order = Window.partitionBy("body_id").orderBy(F.desc("weight"), "partner", F.desc("is_out"))
    return neighbors(conns).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= x)


def top_connections(conns: DataFrame, n: int) -> DataFrame:
    return conns.orderBy(F.desc("weight"), F.desc("weight_hp"), "pre_body", "post_body").limit(n)


def central_synapse(synapses: DataFrame, centroids: DataFrame, bodies: DataFrame | None = None) -> DataFrame:
    """body_id, x, y, z of the synapse nearest to the body's centroid, ties to the smaller point; bodies without
    synapses are at 0, 0, 0."""
    c = centroids.select("body_id", *(F.col(k).alias(f"c{k}") for k in "xyz"))
    near = squared_distance([F.col(k) for k in "xyz"], [F.col(f"c{k}") for k in "xyz"])
    best = synapses.join(c, "body_id").groupBy("body_id").agg(F.min_by(F.struct("x", "y", "z"), F.struct(near.alias("d"), "x", "y", "z")).alias("p")).select("body_id", "p.x", "p.y", "p.z")
    if bodies is None:
        return best
    return bodies.select("body_id").join(best, "body_id", "left").select("body_id", *(F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in "xyz"))


def _boxes(df: DataFrame, keys: list[str], **of) -> DataFrame:
    """The bounds of the places (or of the boxes) below each key."""
    low, high = of.get("low", "{}"), of.get("high", "{}")
    return df.groupBy(*keys).agg(*(F.min(low.format(c)).alias(f"lo{c}") for c in "xyz"), *(F.max(high.format(c)).alias(f"hi{c}") for c in "xyz"))


def _nearest_boxes(met: DataFrame, key: list[str]) -> DataFrame:
    """The rows of points met with boxes whose box may hold the nearest node: its least distance is at most the smallest
    greatest distance of a point's boxes, as every box holds a node."""
    gap = [F.greatest(F.col(f"lo{c}") - F.col(f"p{c}"), F.col(f"p{c}") - F.col(f"hi{c}"), F.lit(0)) for c in "xyz"]
    far = [F.greatest(F.abs(F.col(f"lo{c}") - F.col(f"p{c}")), F.abs(F.col(f"hi{c}") - F.col(f"p{c}"))) for c in "xyz"]
    square = lambda ds: ds[0] * ds[0] + ds[1] * ds[1] + ds[2] * ds[2]
    bound = F.min(square(far)).over(Window.partitionBy(*key))
    return met.withColumns({"_least": square(gap), "_bound": bound}).where("_least <= _bound").drop("_least", "_bound", *(f"{s}{c}" for s in ("lo", "hi") for c in "xyz"))


def nearest_skel_node(skel: DataFrame, points: DataFrame) -> DataFrame:
    """points(point_id, body_id, x, y, z) with the row of the body's nearest node, ties to the smaller row. Points and
    nodes without a place take no part.

    A body's nodes lie in cells of a grid, and those in coarser cells. A point meets its body's coarse cells, then the
    fine cells of the coarse ones that may hold the nearest node, then the nodes of the fine cells that may. The cells' sides
    follow the body's extent and number of nodes, so that for the branching curves that skeletons are each step meets about
    the cube root of the nodes; any side gives the same rows."""
    key = ["point_id", "body_id", "px", "py", "pz"]
    placed = "x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL"
    p = points.where(placed).select("point_id", "body_id", *(F.col(k).alias(f"p{k}") for k in "xyz")).distinct()
    node = skel.where(placed).select("body_id", "row_no", "x", "y", "z")
    extent = F.greatest(*(F.max(c) - F.min(c) for c in "xyz")) + 1
    grid = node.groupBy("body_id").agg(F.count("*").alias("_n"), extent.alias("_e")).select(
        "body_id", F.ceil(F.col("_e") / F.pow("_n", F.lit(4 / 9))).cast("long").alias("_side"), F.ceil(F.pow("_n", F.lit(2 / 9))).cast("long").alias("_ratio"))
    fine = [F.floor(F.col(c) / F.col("_side")).cast("long").alias(f"f{c}") for c in "xyz"]
    coarse = [F.floor(F.floor(F.col(c) / F.col("_side")) / F.col("_ratio")).cast("long").alias(f"c{c}") for c in "xyz"]
    node = node.join(grid, "body_id").select("body_id", "row_no", "x", "y", "z", *fine, *coarse)
    in_coarse, in_fine = ["body_id", "cx", "cy", "cz"], ["body_id", "fx", "fy", "fz"]
    cells = _boxes(node, [*in_coarse, *in_fine[1:]])
    met = _nearest_boxes(p.join(_boxes(cells, in_coarse, low="lo{}", high="hi{}"), "body_id"), key)
    met = _nearest_boxes(met.join(cells, in_coarse), key).drop(*in_coarse[1:])
    near = squared_distance([F.col(k) for k in "xyz"], [F.col(f"p{k}") for k in "xyz"])
    best = met.join(node.drop(*in_coarse[1:]), in_fine).groupBy("point_id", "body_id").agg(F.min(F.struct(near.alias("d"), F.col("row_no").alias("r"))).alias("m"))
    return best.select("point_id", "body_id", F.col("m.r").alias("row_no"), F.sqrt(F.col("m.d").cast("double")).alias("distance"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in the given order. Keys are meant to be nearly unique."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def numbered(df: DataFrame, order: list[str], first: int, column: str = "syn_id") -> DataFrame:
    """Ids from first on in the given order, over all rows: a range sort, counts per partition, and an offset for
    each, so no task sees all rows. The sorted rows are checkpointed with their places, as another range sort could deal
    them otherwise."""
    from axonweave.operators.graph import checkpointed  # graph imports this module

    places = F.monotonically_increasing_id()  # the partition above 33 bits of the row's place in it
    parts = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", places))
    parts = parts.withColumns({"_p": F.shiftright("_m", 33), "_i": F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_m")
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_c"))
    before = sizes.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_b"))  # a row per partition
    return parts.join(F.broadcast(before), "_p").withColumn(column, F.col("_b") + F.col("_i") + first).drop("_p", "_i", "_b")
