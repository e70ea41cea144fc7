"""Scalar functions on Columns: points, names, region counts as maps, ids, status and neuron rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from axonweave.schemas import EVIDENCE, IGNORED_ROIS, RESERVED, ROI_COUNTS, ROI_COUNTS_HP


def point(x: Column, y: Column, z: Column) -> Column:
    """A point, or null unless all coordinates are given."""
    return F.when(x.isNotNull() & y.isNotNull() & z.isNotNull(), F.struct(x.alias("x"), y.alias("y"), z.alias("z")))


def squared_distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    parts = [(p - q) * (p - q) for p, q in zip(a, b)]
    return parts[0] + parts[1] + parts[2]


def distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(squared_distance(a, b).cast("double"))


def half_up(x: Column) -> Column:
    """Round half towards plus infinity, to a whole number."""
    return F.floor(x + F.lit(0.5)).cast("long")


def roi_list(*levels: Column) -> Column:
    """Region names of all levels as one list without blanks and repeats."""
    return F.array_distinct(F.filter(F.array(*levels), lambda r: r.isNotNull() & (F.trim(r) != "")))


def known_rois(rois: Column) -> Column:
    return F.array_except(rois, F.array(*map(F.lit, IGNORED_ROIS)))


def roi_flag(rois: Column, name: str) -> Column:
    """true or null, as the wide form has it."""
    return F.when(F.array_contains(rois, name), F.lit(True))


def roi_name(c: Column) -> Column:
    """Pipes in names of regions stand for commas."""
    return F.translate(c, "|", ",")


def synapse_type(kind: Column) -> Column:
    return F.when(kind.isin("PreSyn", "pre"), "pre").when(kind.isin("PostSyn", "post"), "post")


def status_of(label: Column) -> Column:
    """The status that a status label stands for."""
    return F.when((label == "Leaves") | (label == "Traced") | label.contains(" traced"), "Traced").when(label.isin("Orphan hotknife", "Orphan-artifact"), "Orphan").when(label == "0.5assign", "Assign").otherwise(label)


def cropped_of(label: Column) -> Column:
    return F.when(label == "Leaves", F.lit(True)).when((label == "Traced") | label.contains(" traced"), F.lit(False))


def default_status(status: Column, pre: Column, post: Column, value: str = "Assign") -> Column:
    return F.when((F.coalesce(status, F.lit("")) == "") & ((pre >= 2) | (post >= 10)), value).otherwise(status)


def clean_text(c: Column, commas: bool = False) -> Column:
    """An attribute without line ends at its end and, unless kept, without commas."""
    c = F.regexp_replace(c, r"\n+$", "")
    return c if commas else F.translate(c, ",", "")


def is_high(confidence: Column, threshold: float, strict: bool = True) -> Column:
    return F.coalesce(confidence > threshold if strict else confidence >= threshold, F.lit(False))


def neuron_by_counts(pre: Column, post: Column, threshold: int = 10) -> Column:
    return (F.coalesce(pre, F.lit(0)) >= int(threshold / 5)) | (F.coalesce(post, F.lit(0)) >= threshold)


def neuron_by_evidence(pre: Column, post: Column, attributes: Sequence[str] = EVIDENCE) -> Column:
    some = F.lit(False)
    for a in attributes:
        some = some | F.col(a).isNotNull()
    return (F.coalesce(pre, F.lit(0)) >= 2) | (F.coalesce(post, F.lit(0)) >= 10) | some


def is_reserved(name: Column) -> Column:
    return name.isin(*RESERVED)


def _share_name(entries: Column, total: Column, field: str, threshold: float) -> Column:
    over = F.filter(entries, lambda e: F.coalesce(F.try_divide(e["value"][field].cast("double"), total.cast("double")) > threshold, F.lit(False)))
    joined = F.array_join(F.array_sort(F.transform(over, lambda e: e["key"])), ".")
    return F.when(joined == "", "none").otherwise(joined)


def region_name(roi_info: Column, pre: Column, post: Column, threshold: float, included: Column, excluded: Column | None = None) -> Column:
    """inputs-outputs: included (and not excluded) regions that hold more than threshold of posts or pres."""
    entries = F.filter(F.map_entries(roi_info), lambda e: F.array_contains(included, e["key"]) & (~F.array_contains(excluded, e["key"]) if excluded is not None else F.lit(True)))
    return F.concat_ws("-", _share_name(entries, post, "post", threshold), _share_name(entries, pre, "pre", threshold))


def cluster_name(is_neuron: Column, roi_info: Column, pre: Column, post: Column, super_rois: Column) -> Column:
    return F.when(is_neuron & roi_info.isNotNull() & pre.isNotNull() & post.isNotNull(), region_name(roi_info, pre, post, 0.10, super_rois))


def roi_json(roi_info: Column) -> Column:
    """The map as JSON text with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(roi_info))))


def roi_from_json(text: Column, hp: bool = False) -> Column:
    return F.from_json(text, ROI_COUNTS_HP if hp else ROI_COUNTS)


def _zero(v: Column, field: str) -> Column:
    return F.coalesce(v[field], F.lit(0).cast("long"))


COUNTS, COUNTS_HP = ("pre", "post"), ("pre", "post", "preHP", "postHP")


def roi_merge(a: Column, b: Column, fields: Sequence[str] = COUNTS) -> Column:
    """Sums by region; with COUNTS_HP of all four counts."""
    return F.map_zip_with(a, b, lambda k, x, y: F.struct(*((_zero(x, f) + _zero(y, f)).alias(f) for f in fields)))


def roi_subtract(a: Column, b: Column, fields: Sequence[str] = COUNTS) -> Column:
    """a less b; regions whose pre and post both become 0 go."""
    left = F.map_zip_with(a, b, lambda k, x, y: F.struct(*((_zero(x, f) - _zero(y, f)).alias(f) for f in fields)))
    return F.map_filter(left, lambda k, v: (v["pre"] != 0) | (v["post"] != 0))


def one_synapse(rois: Column, type_: Column, high: Column | None = None) -> Column:
    """What a single synapse adds to its body's region counts; with high, also to those of sure synapses."""
    n = lambda on: F.when(on, 1).otherwise(0).cast("long")
    counts = [n(type_ == "pre").alias("pre"), n(type_ == "post").alias("post")]
    if high is not None:
        counts += [n((type_ == "pre") & high).alias("preHP"), n((type_ == "post") & high).alias("postHP")]
    return F.map_from_entries(F.transform(rois, lambda r: F.struct(r.alias("key"), F.struct(*counts).alias("value"))))


def roi_add(info: Column, rois: Column, type_: Column, high: Column | None = None) -> Column:
    return roi_merge(info, one_synapse(rois, type_, high), COUNTS if high is None else COUNTS_HP)


def roi_remove(info: Column, rois: Column, type_: Column, high: Column | None = None) -> Column:
    return roi_subtract(info, one_synapse(rois, type_, high), COUNTS if high is None else COUNTS_HP)


def body_rois(roi_info: Column) -> Column:
    """The regions of a body, sorted."""
    return F.array_sort(F.map_keys(roi_info))


def composite_id(*parts: Column) -> Column:
    return F.concat_ws(":", *(p.cast("string") for p in parts))


def id_part(c: Column, n: int) -> Column:
    return F.get(F.split(c, ":"), F.lit(n))


def to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def from_epoch(seconds: Column) -> Column:
    """The time that a number of seconds since 1970 in UTC stands for, to the second."""
    return F.timestamp_seconds(F.floor(seconds))


def to_epoch(ts: Column) -> Column:
    """Whole seconds since 1970 in UTC."""
    return F.unix_seconds(ts)


def swc_uuid(path: Column) -> Column:
    """The version that the address of a skeleton names (.../api/node/<uuid>/segmentation...), else `none`."""
    return F.coalesce(F.nullif(F.regexp_extract(path, "/api/node/(.*?)/segmentation", 1), F.lit("")), F.lit("none"))


def swc_body_id(path: Column) -> Column:
    return F.regexp_extract(path, r".*/(.*?)[._]swc", 1).try_cast("long")


def register(spark: SparkSession) -> None:
    """SQL functions for users of spark.sql."""
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION roi_info_as_name(info MAP<STRING, STRUCT<pre: BIGINT, post: BIGINT>>, pre BIGINT, post BIGINT, threshold DOUBLE, included ARRAY<STRING>)
        RETURNS STRING RETURN concat_ws('-',
            coalesce(nullif(array_join(array_sort(transform(filter(map_entries(info), e -> array_contains(included, e.key) AND try_divide(CAST(e.value.post AS DOUBLE), post) > threshold), e -> e.key)), '.'), ''), 'none'),
            coalesce(nullif(array_join(array_sort(transform(filter(map_entries(info), e -> array_contains(included, e.key) AND try_divide(CAST(e.value.pre AS DOUBLE), pre) > threshold), e -> e.key)), '.'), ''), 'none'))"""
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION point_distance(x BIGINT, y BIGINT, z BIGINT, u BIGINT, v BIGINT, w BIGINT) RETURNS DOUBLE RETURN sqrt(CAST((x - u) * (x - u) + (y - v) * (y - v) + (z - w) * (z - w) AS DOUBLE))")
