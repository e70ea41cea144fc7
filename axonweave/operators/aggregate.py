"""Aggregations: connections with weights and region counts, counts of bodies and datasets, feature vectors.

All of them are hash aggregations with map-side partials. Edges are links with both ends resolved: pre_id,
post_id, pre_body, post_body, pre_conf, post_conf, pre_rois, post_rois.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonweave.functions.columns import COUNTS_HP, half_up, is_high, roi_subtract, synapse_type
from axonweave.operators.rank import top_partners, top_roi
from axonweave.schemas import HP_RULES, WEIGHT_MODES

PAIR = ["pre_body", "post_body"]


def _hp(rule: str, pre_hp: float, post_hp: float) -> Column:
    if rule not in HP_RULES:
        raise ValueError(f"hp_rule must be one of {HP_RULES}")
    post = is_high(F.col("post_conf"), post_hp, strict=rule != "post_ge")
    return post & is_high(F.col("pre_conf"), pre_hp) if rule == "both_gt" else post


def connections(edges: DataFrame, pre_hp: float = 0.0, post_hp: float = 0.8, weight_mode: str = "distinct_post", hp_rule: str = "post_gt") -> DataFrame:
    """pre_body, post_body, weight, weight_hp. distinct_post counts distinct posts, edges counts links."""
    if weight_mode not in WEIGHT_MODES:
        raise ValueError(f"weight_mode must be one of {WEIGHT_MODES}")
    hp = _hp(hp_rule, pre_hp, post_hp).alias("hp")
    rows = edges.where("pre_body IS NOT NULL AND post_body IS NOT NULL").select(*PAIR, "post_id", hp)
    if weight_mode == "distinct_post":  # grouped by post first, so that a heavy pair is spread over tasks
        rows = rows.groupBy(*PAIR, "post_id").agg(F.max("hp").alias("hp"))
    return rows.groupBy(*PAIR).agg(F.count("*").alias("weight"), F.count_if("hp").alias("weight_hp"))


def connection_synapses(edges: DataFrame) -> DataFrame:
    """pre_body, post_body, syn_id, side, conf, rois: the distinct synapses of each connection."""
    ends = F.inline(F.array(*(F.struct(F.col(f"{s}_id").alias("syn_id"), F.lit(s).alias("side"), F.col(f"{s}_conf").alias("conf"), F.col(f"{s}_rois").alias("rois")) for s in ("pre", "post"))))
    return edges.where("pre_body IS NOT NULL AND post_body IS NOT NULL").select(*PAIR, ends).dropDuplicates([*PAIR, "syn_id", "side"])


def connection_roi(edges: DataFrame, pre_hp: float = 0.2, post_hp: float = 0.8, per_edge: bool = False) -> DataFrame:
    """pre_body, post_body, roi, pre, post, pre_hp, post_hp. per_edge counts a synapse once for each link."""
    if per_edge:
        ends = F.inline(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"{s}_conf").alias("conf"), F.col(f"{s}_rois").alias("rois")) for s in ("pre", "post"))))
        rows = edges.where("pre_body IS NOT NULL AND post_body IS NOT NULL").select(*PAIR, ends)
    else:
        rows = connection_synapses(edges)
    high = F.when(F.col("side") == "pre", is_high(F.col("conf"), pre_hp)).otherwise(is_high(F.col("conf"), post_hp))
    rows = rows.select(*PAIR, "side", high.alias("high"), F.explode("rois").alias("roi"))
    pre, post = F.col("side") == "pre", F.col("side") == "post"
    return rows.groupBy(*PAIR, "roi").agg(F.count_if(pre).alias("pre"), F.count_if(post).alias("post"), F.count_if(pre & F.col("high")).alias("pre_hp"), F.count_if(post & F.col("high")).alias("post_hp"))


def as_roi_info(long_form: DataFrame, keys: list[str], hp: bool = False) -> DataFrame:
    """The long form per key as a map with sorted region names."""
    fields = [("pre", "pre"), ("post", "post"), *((("pre_hp", "preHP"), ("post_hp", "postHP")) if hp else ())]
    value = F.struct(*(F.col(c).alias(n) for c, n in fields))
    return long_form.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("roi").alias("key"), value.alias("value"))))).alias("roi_info"))


def connections_by_roi(edges: DataFrame, pre_hp: float = 0.2, post_hp: float = 0.8) -> DataFrame:
    """pre_body, post_body, weight, weight_hp (of distinct posts) and roi_info with all four counts, null without regions: what
    `connections` and `connection_roi` say of a pair. Links are dealt by pair once, and all groupings find their rows together;
    a row without region beside those by region counts the synapse as such."""
    dealt = edges.where("pre_body IS NOT NULL AND post_body IS NOT NULL").select(*PAIR, *(f"{s}_{c}" for s in ("pre", "post") for c in ("id", "conf", "rois"))).repartition(*PAIR)
    high = F.when(F.col("side") == "pre", is_high(F.col("conf"), pre_hp)).otherwise(is_high(F.col("conf"), post_hp))
    rows = connection_synapses(dealt).select(*PAIR, "side", high.alias("high"), F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_compact(F.coalesce("rois", F.array().cast("array<string>"))))).alias("roi"))
    pre, post = F.col("side") == "pre", F.col("side") == "post"
    counts = rows.groupBy(*PAIR, "roi").agg(F.count_if(pre).alias("pre"), F.count_if(post).alias("post"), F.count_if(pre & F.col("high")).alias("preHP"), F.count_if(post & F.col("high")).alias("postHP"))
    entry = F.when(F.col("roi").isNotNull(), F.struct(F.col("roi").alias("key"), F.struct("pre", "post", "preHP", "postHP").alias("value")))
    whole = lambda c: F.max(F.when(F.col("roi").isNull(), F.col(c)))
    out = counts.groupBy(*PAIR).agg(whole("post").alias("weight"), whole("postHP").alias("weight_hp"), F.array_sort(F.collect_list(entry)).alias("_e"))
    return out.select(*PAIR, "weight", "weight_hp", F.when(F.size("_e") > 0, F.map_from_entries("_e")).alias("roi_info"))


def body_counts(synapses: DataFrame) -> DataFrame:
    return synapses.where("body_id IS NOT NULL").groupBy("body_id").agg(F.count_if(F.col("type") == "pre").alias("pre"), F.count_if(F.col("type") == "post").alias("post"))


def body_roi_counts(synapses: DataFrame) -> DataFrame:
    return _by_roi(synapses.where("body_id IS NOT NULL"), ["body_id"])


def _by_roi(synapses: DataFrame, keys: list[str]) -> DataFrame:
    rows = synapses.select(*keys, "type", F.explode("rois").alias("roi"))
    return rows.groupBy(*keys, "roi").agg(F.count_if(F.col("type") == "pre").alias("pre"), F.count_if(F.col("type") == "post").alias("post"))


def meta_totals(synapses: DataFrame) -> DataFrame:
    return synapses.agg(F.count_if(F.col("type") == "pre").alias("total_pre"), F.count_if(F.col("type") == "post").alias("total_post"))


def meta_roi(synapses: DataFrame, rois: DataFrame, dataset: str | None = None) -> DataFrame:
    """roi, pre, post for every name in rois (0 if never seen); the dataset's own name gets the totals."""
    found = _by_roi(synapses, [])
    rows = rois.select(F.col("name").alias("roi")).distinct().join(found, "roi", "left").select("roi", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("pre", "post")))
    if dataset is None:
        return rows
    total = meta_totals(synapses).select(F.lit(dataset).alias("roi"), F.col("total_pre").alias("pre"), F.col("total_post").alias("post"))
    return rows.where(F.col("roi") != dataset).unionByName(total)


def super_level_rois(synapses: DataFrame) -> DataFrame:
    """The distinct first-listed regions."""
    return synapses.select(F.get("rois", F.lit(0)).alias("roi")).where("roi IS NOT NULL").distinct()


def load_summary(synapses: DataFrame) -> DataFrame:
    """roi, pre, post, is_super of one load: its counts by region, and over all in a row without region. A row for each region, so
    that loads can be kept and added up without reading their synapses again."""
    counts = _by_roi(synapses, []).where("roi IS NOT NULL").unionByName(meta_totals(synapses).select(F.lit(None).cast("string").alias("roi"), F.col("total_pre").alias("pre"), F.col("total_post").alias("post")))
    return counts.join(super_level_rois(synapses).withColumn("is_super", F.lit(True)), "roi", "left").fillna(False, ["is_super"])


def merged_summaries(*summaries: DataFrame) -> DataFrame:
    """The summary of several loads of different synapses; it can be merged again. A region is super if it is so in any."""
    rows = reduce(DataFrame.unionByName, summaries)
    return rows.groupBy("roi").agg(F.sum("pre").alias("pre"), F.sum("post").alias("post"), F.max("is_super").alias("is_super"))


def meta_of_summary(summary: DataFrame, rois: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals, region counts and super regions, as `meta_totals`, `meta_roi` and `super_level_rois` have them."""
    totals = summary.where("roi IS NULL").select(F.col("pre").alias("total_pre"), F.col("post").alias("total_post"))
    seen = rois.select(F.col("name").alias("roi")).distinct().join(summary.select("roi", "pre", "post"), "roi", "left").fillna(0, ["pre", "post"]).where(F.col("roi") != dataset)
    return totals, seen.unionByName(totals.select(F.lit(dataset).alias("roi"), F.col("total_pre").alias("pre"), F.col("total_post").alias("post"))), summary.where("is_super").select("roi")


def partner_counts(edges: DataFrame) -> DataFrame:
    """body_id, downstream (links from its pres), upstream (links to its posts)."""
    out = edges.where("pre_body IS NOT NULL").groupBy(F.col("pre_body").alias("body_id")).agg(F.count("*").alias("downstream"))
    into = edges.where("post_body IS NOT NULL").groupBy(F.col("post_body").alias("body_id")).agg(F.count("*").alias("upstream"))
    return out.join(into, "body_id", "full_outer").select("body_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("downstream", "upstream")))


def downstream_by_roi(edges: DataFrame) -> DataFrame:
    """body_id, roi, downstream: links by the region of the pre end."""
    return edges.where("pre_body IS NOT NULL").select(F.col("pre_body").alias("body_id"), F.explode("pre_rois").alias("roi")).groupBy("body_id", "roi").agg(F.count("*").alias("downstream"))


def synapse_set_roi_counts(edges: DataFrame, pre_hp: float = 0.0, post_hp: float = 0.0) -> DataFrame:
    """set_id, roi, weight, weight_hp: the two sets of each pair of bodies, counted once for each link."""
    sides = [F.struct(F.concat_ws("_", "pre_body", "post_body", F.lit("pre")).alias("set_id"), F.col("pre_rois").alias("rois"), is_high(F.col("pre_conf"), pre_hp).alias("high"))]
    sides.append(F.struct(F.concat_ws("_", "post_body", "pre_body", F.lit("post")).alias("set_id"), F.col("post_rois").alias("rois"), is_high(F.col("post_conf"), post_hp).alias("high")))
    rows = edges.select(F.inline(F.array(*sides))).select("set_id", F.explode("rois").alias("roi"), "high")
    return rows.groupBy("set_id", "roi").agg(F.count("*").alias("weight"), F.count_if("high").alias("weight_hp"))


def roi_counts(synapses: DataFrame) -> DataFrame:
    """body_id, roi, inputs, outputs per region, and a row named total (regions overlap, so it is no sum)."""
    total = body_counts(synapses).select("body_id", F.lit("total").alias("roi"), "pre", "post")
    return body_roi_counts(synapses).unionByName(total).select("body_id", "roi", F.col("post").alias("inputs"), F.col("pre").alias("outputs"))


def feature_vectors(bodies: DataFrame, by_roi: DataFrame, rois: list[str], roi: str | None = None, roi_threshold: int = 0, threshold: int = 0) -> DataFrame:
    """body_id, inputs, outputs: arrays over the sorted regions, of bodies with pre + post > threshold and, if a
    region is given, with more than roi_threshold synapses in it. bodies: body_id, pre, post."""
    chosen = bodies.where(F.col("pre") + F.col("post") > threshold).select("body_id")
    if roi is not None:
        chosen = chosen.join(by_roi.where((F.col("roi") == roi) & (F.col("pre") + F.col("post") > roi_threshold)).select("body_id"), "body_id", "left_semi")
    axis = F.array(*map(F.lit, sorted(rois))).cast("array<string>")
    maps = as_roi_info(by_roi, ["body_id"])
    dense = lambda c: F.transform(axis, lambda r: F.coalesce(F.try_element_at("roi_info", r)[c], F.lit(0).cast("long")))
    rows = chosen.join(maps, "body_id", "left").withColumn("roi_info", F.coalesce("roi_info", F.create_map().cast(dict(maps.dtypes)["roi_info"])))
    return rows.select("body_id", dense("post").alias("inputs"), dense("pre").alias("outputs"))


def feature_vectors_topx(bodies: DataFrame, by_roi: DataFrame, conns: DataFrame, rois: list[str], x: int, roi: str | None = None, roi_threshold: int = 0, threshold: int = 0) -> DataFrame:
    """feature_vectors with the sets of the x strongest partners, in and out; partners that are not chosen
    themselves follow as rows with is_primary false and empty sets."""
    vectors = feature_vectors(bodies, by_roi, rois, roi, roi_threshold, threshold)
    best = top_partners(conns, x).join(vectors.select("body_id"), "body_id", "left_semi")
    sets = best.groupBy("body_id").agg(F.sort_array(F.collect_set(F.when(~F.col("is_out"), F.col("partner")))).alias("input_ids"), F.sort_array(F.collect_set(F.when(F.col("is_out"), F.col("partner")))).alias("output_ids"))
    empty = F.array().cast("array<bigint>")
    primary = vectors.join(sets, "body_id", "left").select("*", F.lit(True).alias("is_primary"))
    others = best.select(F.col("partner").alias("body_id")).distinct().join(vectors.select("body_id"), "body_id", "left_anti")
    every = feature_vectors(bodies.join(others, "body_id", "left_semi"), by_roi, rois, threshold=-1)
    rows = primary.unionByName(every.select("*", empty.alias("input_ids"), empty.alias("output_ids"), F.lit(False).alias("is_primary")))
    return rows.select("body_id", "inputs", "outputs", F.coalesce("input_ids", empty).alias("input_ids"), F.coalesce("output_ids", empty).alias("output_ids"), "is_primary")


def connection_categories(edges: DataFrame, by_roi: DataFrame, neurons: DataFrame) -> DataFrame:
    """body_id, category, pre, post: for each link of its pres, a post for the partner's top output region; for
    each link of its posts, a pre for the partner's top input region. Partners are neurons (body_id) only."""
    top_out, top_in = top_roi(by_roi, "pre").select("body_id", "roi"), top_roi(by_roi, "post").select("body_id", "roi")
    # links are counted by pair once for both directions; a partner that is null is no neuron
    pairs = edges.where("pre_body IS NOT NULL AND post_body IS NOT NULL").groupBy(*PAIR).agg(F.count("*").alias("n"))
    own = lambda a, b, top, side: (
        pairs.select(F.col(f"{a}_body").alias("own"), F.col(f"{b}_body").alias("body_id"), "n")
        .join(neurons.select("body_id"), "body_id", "left_semi").join(top, "body_id", "left").select(F.col("own").alias("body_id"), F.coalesce("roi", F.lit("None")).alias("category"), F.lit(side).alias("side"), "n")
    )
    rows = own("pre", "post", top_out, "post").unionByName(own("post", "pre", top_in, "pre"))
    return rows.groupBy("body_id", "category").agg(*(F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).alias(s) for s in ("pre", "post")))


def centroid(synapses: DataFrame) -> DataFrame:
    """body_id, x, y, z: the rounded mean of the distinct places of a body's synapses."""
    places = synapses.where("body_id IS NOT NULL").select("body_id", "x", "y", "z").distinct()
    return places.groupBy("body_id").agg(*(half_up(F.sum(c) / F.count("*")).alias(c) for c in ("x", "y", "z")))


def connection_vertices(edges: DataFrame, threshold: int = 0) -> DataFrame:
    """pre_body, post_body, pre, post, x, y, z: connections as points. pre and post count distinct places by
    side; the sum over the union of places is divided by pre + post, which exceeds the union's size if a pre and a
    post share a place. Only vertices with pre + post > threshold."""
    ends = F.inline(F.array(*(F.struct(F.lit(s).alias("side"), *(F.col(f"{s}_{c}").alias(c) for c in "xyz")) for s in ("pre", "post"))))
    # links are dealt by pair once, before each becomes two places; both groupings then find their rows together
    links = edges.where("pre_body IS NOT NULL AND post_body IS NOT NULL").select(*PAIR, *(f"{s}_{c}" for s in ("pre", "post") for c in "xyz")).repartition(*PAIR)
    places = links.select(*PAIR, ends).groupBy(*PAIR, "x", "y", "z").agg(F.count_if(F.col("side") == "pre").alias("a"), F.count_if(F.col("side") == "post").alias("b"))
    sums = places.groupBy(*PAIR).agg(F.count_if(F.col("a") > 0).alias("pre"), F.count_if(F.col("b") > 0).alias("post"), *(F.sum(c).alias(c) for c in "xyz"))
    n = F.col("pre") + F.col("post")
    return sums.where(n > threshold).select(*PAIR, "pre", "post", *(half_up(F.col(c) / n).alias(c) for c in "xyz"))


def merge_properties(bodies: DataFrame, merges: DataFrame, sums: tuple[str, ...] = ("pre", "post", "size"), first_only: tuple[str, ...] = ("cropped",)) -> DataFrame:
    """Attributes of merged bodies. merges(target, body_id, position): sums for counts; for the rest the first
    value that is not null in list order; first_only attributes come from the first body alone."""
    rows = merges.join(bodies, "body_id")
    rest = [c for c in bodies.columns if c not in ("body_id", *sums, *first_only)]
    out = [F.sum(c).alias(c) for c in sums if c in bodies.columns]
    out += [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("position"))).alias(c) for c in rest]
    out += [F.min_by(c, "position").alias(c) for c in first_only if c in bodies.columns]
    return rows.groupBy(F.col("target").alias("body_id")).agg(*out)


def subtract_connections(conns: DataFrame, part: DataFrame) -> DataFrame:
    """conns less part, by pair: weight, weight_hp and roi_info (with all four counts). Pairs whose weight becomes 0
    go."""
    gone = part.select(*PAIR, F.col("weight").alias("_w"), F.col("weight_hp").alias("_h"), F.col("roi_info").alias("_r"))
    rows = conns.join(gone, PAIR, "left")
    none = F.create_map().cast(dict(conns.dtypes)["roi_info"])
    less = lambda a, b: (F.col(a) - F.coalesce(b, F.lit(0))).alias(a)
    left = rows.select(*PAIR, less("weight", "_w"), less("weight_hp", "_h"), roi_subtract(F.coalesce("roi_info", none), F.coalesce("_r", none), COUNTS_HP).alias("roi_info"))
    return left.where("weight > 0")


def skeleton_stats(skel: DataFrame) -> DataFrame:
    """body_id, nodes, roots, max_degree (links of the best linked node)."""
    children = skel.where("parent_row <> -1").groupBy("body_id", F.col("parent_row").alias("row_no")).agg(F.count("*").alias("c"))
    rows = skel.join(children, ["body_id", "row_no"], "left").withColumn("degree", F.coalesce("c", F.lit(0)) + F.when(F.col("parent_row") == -1, 0).otherwise(1))
    return rows.groupBy("body_id").agg(F.count("*").alias("nodes"), F.count_if(F.col("parent_row") == -1).alias("roots"), F.max("degree").alias("max_degree"))


def typed(synapses: DataFrame) -> DataFrame:
    """Synapses whose kind says which side they are."""
    return synapses.withColumn("type", synapse_type(F.col("type"))).where("type IS NOT NULL")
