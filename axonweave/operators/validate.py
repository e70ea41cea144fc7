"""Data quality: every check returns the good rows and the rejected rows with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonweave.schemas import RESERVED

Checked = tuple[DataFrame, DataFrame]


def split(df: DataFrame, rules: list[tuple[Column, str]]) -> Checked:
    """rules: conditions under which a row is bad, and why; the first that holds is the reason."""
    reason = F.coalesce(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(why)) for bad, why in rules))
    marked = df.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def bad_location(c: Column) -> Column:
    return c.isNull() | (F.size(c) != 3) | ~F.forall(c, lambda x: x.isNotNull() & (x == F.floor(x)))


def check_synapses(df: DataFrame) -> Checked:
    """type pre or post, confidence (if given) within 0 and 1, location of three whole numbers."""
    return split(df, [(F.col("type").isNull(), "type is missing"), (~F.col("type").isin("pre", "post"), "type is neither pre nor post"), (~F.coalesce("confidence", F.lit(0.0)).between(0, 1), "confidence is outside 0 to 1"), (bad_location(F.col("location")), "location is not three whole numbers")])


def check_edges(df: DataFrame) -> Checked:
    return split(df, [(bad_location(F.col("pre")), "pre is missing or no location"), (bad_location(F.col("post")), "post is missing or no location")])


def check_bodies(df: DataFrame) -> Checked:
    """A whole id; a soma, unless it is empty, with location and radius."""
    soma = F.col("soma")
    some = soma.isNotNull() & (soma["location"].isNotNull() | soma["radius"].isNotNull())
    return split(df, [(F.col("id").isNull(), "id is missing"), (F.col("id") != F.floor("id"), "id is no whole number"), (some & (bad_location(soma["location"]) | soma["radius"].isNull()), "soma lacks location or radius")])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unknown(keys: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    return keys.join(known.select(*on), on, "left_anti")


def unstamped(df: DataFrame) -> DataFrame:
    """Rows without dataset or time stamp."""
    return df.where("dataset IS NULL OR ts IS NULL")


def check_dataset(name: str) -> str:
    if not name or name in RESERVED:
        raise ValueError(f"{name!r} cannot name a dataset")
    return name
