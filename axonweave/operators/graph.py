"""Graph and spatial operators: shortest paths, trees of skeleton nodes, line graphs.

Iterations keep their state as DataFrames and cut the lineage each round by writing it to the shared folder.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from axonweave.functions.columns import distance, half_up
from axonweave.operators.aggregate import centroid, connection_vertices
from axonweave.operators.rank import nearest_skel_node

#: Longer walks than this many links are an error, not a silent cut.
MAX_ROUNDS = 10_000
#: Rows of a key that are paired with each other or with another block in one task.
BLOCK = 1024
#: Up to so many bodies, a few hundred KB, are sent to every task that reads links.
FEW = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names. In local mode an unset one is a temporary folder."""
    if not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept as a table in the shared folder. Unlike checkpoint(), which computes df for its rows
    and again for its file, this writes once, and what reads it knows its size and can prune columns."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _arcs(conns: DataFrame, weight: str = "weight", default: float = float("nan"), threshold: str = "weight", least: float = 0, direction: str = "out") -> DataFrame:
    """a, b, w: the lightest arc from a to b of the connections that a search may take."""
    kept = conns.where(F.col(threshold) >= least).select("pre_body", "post_body", F.coalesce(F.col(weight).cast("double"), F.lit(default)).alias("w"))
    out, back = kept.select(F.col("pre_body").alias("a"), F.col("post_body").alias("b"), "w"), kept.select(F.col("post_body").alias("a"), F.col("pre_body").alias("b"), "w")
    arcs = {"out": out, "in": back, "both": out.union(back)}[direction].where("NOT isnan(w)").groupBy("a", "b").agg(F.min("w").alias("w"))
    arcs = checkpointed(arcs)
    if not arcs.where("w < 0").isEmpty():
        raise ValueError("weights must not be negative")
    return arcs


def _relaxed(best: DataFrame, front: DataFrame, arcs: DataFrame, root: str) -> DataFrame:
    """best(root, body_id, distance, fresh) after one link from the rows in front; fresh marks rows that fell."""
    step = front.join(arcs, F.col("body_id") == F.col("a")).groupBy(root, F.col("b").alias("body_id")).agg(F.min(F.col("distance") + F.col("w")).alias("d"))
    merged = best.join(step, [root, "body_id"], "full_outer")
    better = F.coalesce(F.col("d") < F.col("distance"), F.col("d").isNotNull())
    return checkpointed(merged.select(root, "body_id", F.when(better, F.col("d")).otherwise(F.col("distance")).alias("distance"), better.alias("fresh")))


def _starts(rows: DataFrame, root: str) -> DataFrame:
    return checkpointed(rows.select(root).distinct().select(root, F.col(root).alias("body_id"), F.lit(0.0).alias("distance"), F.lit(True).alias("fresh")))


def shortest_distances(conns: DataFrame, sources: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Distances (source, body_id, distance) from sources(source) by rounds of relaxation, and the arcs used.

    Connections whose threshold property is below least are left out before the search. direction: out follows
    pre to post, in the reverse, both either way. A missing weight is default; NaN never improves a path.
    Negative weights are an error. Only bodies whose distance fell in the last round are expanded.
    """
    arcs, best = _arcs(conns, **options), _starts(sources, "source")
    for _ in range(MAX_ROUNDS):
        best = _relaxed(best, best.where("fresh"), arcs, "source")
        if best.where("fresh").isEmpty():
            return best.drop("fresh"), arcs
    raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")


def _from_both_ends(pairs: DataFrame, arcs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """pairs(source, target) with the distance of those that a path joins; distances from the sources, and to the targets.

    Both ends are searched at once. As soon as a pair's searches meet, its distance is at most what they have there, and
    neither goes on from bodies farther than half of it: a body of a shortest path lies within half of the distance of one
    end, and so do all between the two. A pair whose search has ended on one side without meeting has no path."""
    back = arcs.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")
    ahead, behind = _starts(pairs, "source"), _starts(pairs, "target")
    for _ in range(MAX_ROUNDS):
        near, far = ahead.select("source", "body_id", F.col("distance").alias("d1")), behind.select("target", "body_id", F.col("distance").alias("d2"))
        met = pairs.join(near, "source").join(far, ["target", "body_id"]).groupBy("source", "target").agg(F.min(F.col("d1") + F.col("d2")).alias("distance"))
        going = [best.where("fresh").groupBy(root).agg(F.max(F.lit(True)).alias(f"_{root}")) for best, root in ((ahead, "source"), (behind, "target"))]
        state = checkpointed(pairs.join(met, ["source", "target"], "left").join(going[0], "source", "left").join(going[1], "target", "left").where("distance IS NOT NULL OR (_source AND _target)").select("source", "target", "distance"))
        fronts = []
        for best, root in ((ahead, "source"), (behind, "target")):
            limit = state.groupBy(root).agg(F.max(F.coalesce(F.col("distance") / 2, F.lit(float("inf")))).alias("limit"))
            fronts.append(checkpointed(best.where("fresh").join(limit, root).where("distance <= limit + 1e-9").select(root, "body_id", "distance")))
        if all(front.isEmpty() for front in fronts):
            return state.where("distance IS NOT NULL"), ahead.drop("fresh"), behind.drop("fresh")
        ahead, behind = _relaxed(ahead, fronts[0], arcs, "source"), _relaxed(behind, fronts[1], back, "target")
    raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")


def shortest_paths(conns: DataFrame, pairs: DataFrame, max_hops: int = MAX_ROUNDS, **options) -> DataFrame:
    """pairs(source, target) -> source, target, distance, path (array of bodies): every tied shortest path.

    A path has one link over the half of its distance (none, if that is 0). Paths are built from these links to both ends, over arcs
    that lie on shortest paths; arcs of weight 0 are walked at most once per path. Pairs without a path, and sources as their own
    targets, give no row. A path of more than max_hops links is an error.
    """
    wanted = checkpointed(pairs.select("source", "target").where("source <> target").distinct())
    arcs = _arcs(conns, **options)
    ends, ahead, behind = _from_both_ends(wanted, arcs)
    prior = lambda name: ahead.select("source", F.col("body_id").alias(name), F.col("distance").alias("d"))
    after = lambda name: behind.select("target", F.col("body_id").alias(name), F.col("distance").alias("e"))
    half = F.col("distance") / 2
    over = ends.join(prior("a"), "source").where(F.col("d") <= half).join(arcs, "a").where(F.col("d") + F.col("w") > half).join(after("b"), ["target", "b"])
    over = over.where(F.abs(F.col("d") + F.col("w") + F.col("e") - F.col("distance")) <= 1e-9).select("source", "target", "distance", F.array("a", "b").alias("path"), "d", "e")
    flat = ends.where("distance = 0").select("source", "target", "distance", F.array("target").alias("path"), F.lit(0.0).alias("d"), F.lit(0.0).alias("e"))
    walk, done = checkpointed(over.unionByName(flat)), []
    # to the source, then to the target; rows are those that are not there yet
    for end, at, rest, step in (("source", F.get("path", F.lit(0)), "d", lambda w: w.join(arcs, F.col("_at") == F.col("b")).join(prior("a").withColumnRenamed("d", "_d"), ["source", "a"]).select("*", F.col("a").alias("_new"))),
                                ("target", F.get("path", F.size("path") - 1), "e", lambda w: w.join(arcs, F.col("_at") == F.col("a")).join(after("b").withColumnRenamed("e", "_d"), ["target", "b"]).select("*", F.col("b").alias("_new")))):
        done = []
        while True:
            placed = walk.withColumn("_at", at)
            done.append(placed.where(F.col("_at") == F.col(end)).drop("_at"))
            left = placed.where(F.col("_at") != F.col(end))
            if left.isEmpty():
                break
            if not left.where(F.size("path") > max_hops).isEmpty():
                raise RuntimeError(f"paths of more than {max_hops} links")
            on = step(left).where((F.abs(F.col("_d") + F.col("w") - F.col(rest)) <= 1e-9) & ~F.array_contains("path", F.col("_new")))
            longer = F.concat(F.array("_new"), "path") if end == "source" else F.concat("path", F.array("_new"))
            walk = checkpointed(on.select("source", "target", "distance", longer.alias("path"), *((F.col("_d").alias(c) if c == rest else F.col(c)) for c in "de")))
        walk = reduce(DataFrame.unionByName, done)
    if not walk.where(F.size("path") - 1 > max_hops).isEmpty():
        raise RuntimeError(f"paths of more than {max_hops} links")
    return walk.select("source", "target", "distance", "path").distinct()


def skeleton_links(skel: DataFrame) -> DataFrame:
    """body_id, parent_row, row_no: a link for each node with a parent in the same skeleton."""
    parents = skel.select("body_id", F.col("row_no").alias("parent_row"))
    return skel.where("parent_row <> -1").select("body_id", "row_no", "parent_row").join(parents, ["body_id", "parent_row"]).select("body_id", "parent_row", "row_no")


def roots(skel: DataFrame) -> DataFrame:
    return skel.where("parent_row = -1").select("body_id", "row_no")


def jump_tables(skel: DataFrame) -> list[DataFrame]:
    """Tables k = 0, 1, ... of body_id, row_no, up, len: the ancestor 2**k links above, for the nodes that have one, and the
    length to it. Each is the one before joined with itself; there are as many as the deepest node's depth has bits."""
    place = skel.select("body_id", F.col("row_no").alias("parent_row"), *(F.col(c).alias(f"p{c}") for c in "xyz"))
    jump = skel.select("body_id", "row_no", "parent_row", "x", "y", "z").where("parent_row <> -1").join(place, ["body_id", "parent_row"])
    jump = jump.select("body_id", "row_no", F.col("parent_row").alias("up"), distance([F.col(c) for c in "xyz"], [F.col(f"p{c}") for c in "xyz"]).alias("len"))
    tables, links = [], None
    while True:
        jump = checkpointed(jump)
        if jump.isEmpty():
            return tables
        links = jump.count() if links is None else links
        if 1 << len(tables) > links:
            raise ValueError("nodes of a skeleton are their own ancestors")
        tables.append(jump)
        above = jump.select("body_id", F.col("row_no").alias("up"), F.col("up").alias("up2"), F.col("len").alias("len2"))
        jump = jump.join(above, ["body_id", "up"]).select("body_id", "row_no", F.col("up2").alias("up"), (F.col("len") + F.col("len2")).alias("len"))


def _lifted(rows: DataFrame, jump: DataFrame, side: str) -> DataFrame:
    """rows with up_<side> and len_<side>: the jump from the node in column side, null if it has none."""
    return rows.join(jump.select("body_id", F.col("row_no").alias(side), F.col("up").alias(f"up_{side}"), F.col("len").alias(f"len_{side}")), ["body_id", side], "left")


def with_depth(nodes: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """nodes(body_id, row_no) with depth and root, by the longest jumps that each has."""
    at = nodes.withColumns({"at": F.col("row_no"), "depth": F.lit(0).cast("long")})
    for k, jump in reversed(list(enumerate(jumps))):
        at = _lifted(at, jump, "at").select("body_id", "row_no", F.coalesce("up_at", "at").alias("at"), F.when(F.col("up_at").isNotNull(), F.col("depth") + (1 << k)).otherwise(F.col("depth")).alias("depth"))
    return at.withColumnRenamed("at", "root")


def cable_distance(skel: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(body_id, a, b) -> body_id, a, b, distance: the rounded length along the skeleton between two rows.
    Equal rows have 0; rows under different roots, or that do not exist, have null. A skeleton with a circle is an error.

    Both ends are lifted by jump tables: the deeper one to the other's depth, then both, by ever shorter jumps, as long as they
    stay apart; their common ancestor is one link above. A pair is one row throughout."""
    wanted = checkpointed(pairs.select("body_id", "a", "b").distinct())
    of_pairs = skel.join(wanted.select("body_id").distinct(), "body_id", "left_semi")
    ends = wanted.select("body_id", F.explode(F.array("a", "b")).alias("row_no")).distinct().join(of_pairs.select("body_id", "row_no"), ["body_id", "row_no"], "left_semi")
    jumps = jump_tables(of_pairs)
    deep = checkpointed(with_depth(ends, jumps))
    end = lambda c: deep.select("body_id", F.col("row_no").alias(c), F.col("depth").alias(f"depth_{c}"), F.col("root").alias(f"root_{c}"))
    at = wanted.join(end("a"), ["body_id", "a"]).join(end("b"), ["body_id", "b"]).where("root_a = root_b")
    deeper = F.col("depth_a") >= F.col("depth_b")
    at = at.select("body_id", "a", "b", F.when(deeper, F.col("a")).otherwise(F.col("b")).alias("low"), F.when(deeper, F.col("b")).otherwise(F.col("a")).alias("high"), F.abs(F.col("depth_a") - F.col("depth_b")).alias("rest"), F.lit(0.0).alias("length"))
    kept = ["body_id", "a", "b"]
    for k, jump in reversed(list(enumerate(jumps))):
        go = F.col("rest").bitwiseAND(1 << k) != 0
        at = _lifted(at, jump, "low").select(*kept, F.when(go, F.col("up_low")).otherwise(F.col("low")).alias("low"), "high", "rest", F.when(go, F.col("length") + F.col("len_low")).otherwise(F.col("length")).alias("length"))
    at = checkpointed(at.drop("rest"))
    for jump in reversed(jumps):
        at = _climbed(at, jump, F.col("up_low") != F.col("up_high"))
    if jumps:
        at = _climbed(at, jumps[0], F.col("low") != F.col("high"))
    return wanted.join(at.select(*kept, "length"), kept, "left").select(*kept, half_up(F.col("length")).alias("distance"))


def _climbed(at: DataFrame, jump: DataFrame, go: Column) -> DataFrame:
    """Both ends after one jump, where go says so."""
    both = _lifted(_lifted(at, jump, "low"), jump, "high").withColumn("_go", F.coalesce(go, F.lit(False)))
    moved = lambda c: F.when(F.col("_go"), F.col(f"up_{c}")).otherwise(F.col(c)).alias(c)
    return both.select("body_id", "a", "b", moved("low"), moved("high"), F.when(F.col("_go"), F.col("length") + F.col("len_low") + F.col("len_high")).otherwise(F.col("length")).alias("length"))


def pairs_within(rows: DataFrame, key: str, order: str, block: int = BLOCK) -> DataFrame:
    """Every two rows with one key once, as columns a and b (structs of the other columns) with a's order below b's.

    The rows of a key are dealt to blocks of about the given size, and each two blocks are a join key of their own, so a key with
    many rows is many small tasks. A row is sent to as many keys as its key has blocks, far fewer than it has pairs."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / block).cast("long").alias("_blocks"))
    dealt = rows.select(key, F.struct(*(c for c in rows.columns if c != key)).alias("_row")).join(sizes, key)
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64(f"_row.{order}"), F.col("_blocks")))
    dealt = dealt.withColumn("_other", F.explode(F.expr("sequence(0L, _blocks - 1)")))
    side = lambda name: dealt.select(key, F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"), F.col("_own").alias(f"_{name}"), F.col("_row").alias(name))
    met = side("a").join(side("b"), [key, "_low", "_high"]).where(f"a.{order} < b.{order} AND (_low = _high OR _a <> _b)")
    return met.select(key, "a", "b")


def body_vertices(edges: DataFrame, bodies: DataFrame, threshold: int = 0, few: int = FEW) -> DataFrame:
    """body_id, pre_body, post_body, pre, post, x, y, z, vertex: the connections of each body in bodies(body_id) as points.

    Links are read once. Those of a few bodies are picked out as they are read; of more, all links are dealt by pair, as whole
    rows would be dealt by either end, and the points that no body asks for go after that."""
    wanted = checkpointed(bodies.select("body_id").where("body_id IS NOT NULL").distinct())
    if wanted.count() <= few:
        mark = lambda s: F.broadcast(wanted.select(F.col("body_id").alias(f"{s}_body"), F.lit(True).alias(f"_{s}")))
        edges = edges.join(mark("pre"), "pre_body", "left").join(mark("post"), "post_body", "left").where("_pre OR _post")
    points = connection_vertices(edges, threshold)
    own = points.withColumn("body_id", F.explode(F.array_distinct(F.array("pre_body", "post_body")))).join(wanted, "body_id", "left_semi")
    return own.withColumn("vertex", F.concat_ws("_", "pre_body", "post_body"))


def line_graph(edges: DataFrame, bodies: DataFrame, threshold: int = 0, skel: DataFrame | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The line graph of each body in bodies(body_id): vertices are its connections (with body_id), edges pairs of
    vertices of one body with their distance; with skel, also the cable distance between the nodes nearest to
    them. Pairs have source < target once."""
    vertices = checkpointed(body_vertices(edges, bodies, threshold))
    ends = vertices.select("body_id", "vertex", "x", "y", "z")
    if skel is not None:
        node = nearest_skel_node(skel, ends.withColumnRenamed("vertex", "point_id")).select("body_id", F.col("point_id").alias("vertex"), "row_no")
        ends = checkpointed(ends.join(node, ["body_id", "vertex"], "left"))
    pairs = pairs_within(ends, "body_id", "vertex", block)
    apart = half_up(distance([F.col(f"a.{c}") for c in "xyz"], [F.col(f"b.{c}") for c in "xyz"])).alias("distance")
    out = pairs.select("body_id", F.col("a.vertex").alias("source"), F.col("b.vertex").alias("target"), apart, *([F.col(f"{s}.row_no").alias(s) for s in "ab"] if skel is not None else []))
    if skel is not None:
        out = checkpointed(out)
        cable = cable_distance(skel, out.where("a IS NOT NULL AND b IS NOT NULL")).withColumnRenamed("distance", "cable_distance")
        out = out.join(cable, ["body_id", "a", "b"], "left").drop("a", "b")
    return vertices, out


def centroids_and_skeleton(edges: DataFrame, skel: DataFrame, bodies: DataFrame, threshold: int = 0) -> tuple[DataFrame, DataFrame]:
    """The connections of bodies as points, and the bodies' skeleton rows."""
    return body_vertices(edges, bodies, threshold), skel.join(bodies.select("body_id"), "body_id", "left_semi")


def bodies_in_roi(bodies: DataFrame, by_roi: DataFrame, roi: str, roi_threshold: int = 0, threshold: int = 0) -> DataFrame:
    some = by_roi.where((F.col("roi") == roi) & (F.col("pre") + F.col("post") > roi_threshold)).select("body_id")
    return bodies.where(F.col("pre") + F.col("post") > threshold).join(some, "body_id", "left_semi").select("body_id")


def line_graph_roi(edges: DataFrame, bodies: DataFrame, by_roi: DataFrame, roi: str, roi_threshold: int = 0, threshold: int = 0, vertex_threshold: int = 0) -> tuple[DataFrame, DataFrame]:
    """The line graphs of the bodies with more than threshold synapses, more than roi_threshold of them in the region."""
    return line_graph(edges, bodies_in_roi(bodies, by_roi, roi, roi_threshold, threshold), vertex_threshold)


__all__ = ["body_vertices", "cable_distance", "centroid", "centroids_and_skeleton", "jump_tables", "line_graph", "line_graph_roi", "pairs_within", "roots", "shortest_distances", "shortest_paths", "skeleton_links"]
