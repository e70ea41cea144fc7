"""The edit feed: a stream of edits applied to a stored graph, one delta per micro-batch.

A store has versions. Version k is the last base at or before k with the deltas after it, merged when it is read. A batch writes
what it changes and nothing else; a base is written rarely. A version is listed in the manifest after its data are there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from axonweave.plans.changes import KEYS, with_delta
from axonweave.plans.edits import changed_rows, edited, merged
from axonweave.plans.load import Graph

TABLES = ("synapse", "syn_edge", "membership", "body", "skel_node", "applied")
MANIFEST = "tables ARRAY<STRING>, version INT, kind STRING"
#: A base is written every so many batches.
COMPACT_EVERY = 50


def _write(spark: SparkSession, tables: Graph, path: str, version: int, kind: str) -> None:
    """Each table is written once, and a delta without rows is not listed."""
    held = []
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/v{version}/{kind}/{name}")
        if kind == "base" or not spark.read.schema(df.schema).parquet(f"{path}/v{version}/{kind}/{name}").isEmpty():
            held.append(name)
    listed = spark.createDataFrame([(sorted(held),)], "tables ARRAY<STRING>")
    listed.coalesce(1).write.mode("overwrite").json(f"{path}/manifest/version={version}/kind={kind}")


def save_snapshot(graph: Graph, path: str, version: int) -> None:
    """graph as a base. Its spark session is that of any of its tables."""
    _write(next(iter(graph.values())).sparkSession, graph, path, version, "base")


def versions(spark: SparkSession, path: str) -> list[tuple[int, str, list[str]]]:
    """version, kind and tables of all that the store holds, a row for each batch and base."""
    listed = spark.read.schema(MANIFEST).option("basePath", f"{path}/manifest").json(f"{path}/manifest")
    return sorted((r.version, r.kind, list(r.tables)) for r in listed.collect())


def load_snapshot(spark: SparkSession, path: str, version: int) -> Graph:
    """Tables of one version; those that it does not hold are left out."""
    listed = [v for v in versions(spark, path) if v[0] <= version]
    if version not in {v for v, _, _ in listed}:
        raise ValueError(f"there is no version {version}")
    start, _, names = max(v for v in listed if v[1] == "base")
    out: Graph = {t: spark.read.parquet(f"{path}/v{start}/base/{t}") for t in names}
    later = [v for v in listed if v[0] > start and v[1] == "delta"]
    for t in TABLES:
        parts = [spark.read.parquet(f"{path}/v{v}/delta/{t}") for v, _, held in later if t in held]
        if parts and t not in out:
            out[t] = with_delta(parts[0].drop("_gone").limit(0), parts, KEYS[t])
        elif parts:
            out[t] = with_delta(out[t], parts, KEYS[t])
    return out


def apply_batch(spark: SparkSession, path: str, version: int, edits: DataFrame) -> tuple[Graph, DataFrame, DataFrame]:
    """Make version + 1 of version and edits: writes the rows that change. Running it again writes the same."""
    graph = load_snapshot(spark, path, version)
    part = edited(graph, edits)
    _write(spark, changed_rows(part), path, version + 1, "delta")
    return merged(graph, part), part.touched, part.rejected


def compact(spark: SparkSession, path: str, version: int) -> None:
    """Write a base for a version, so that reading it and later ones needs no earlier delta."""
    save_snapshot(load_snapshot(spark, path, version), path, version)


def follow(edits: DataFrame, path: str, checkpoint: str, on_batch=None, compact_every: int = COMPACT_EVERY, **trigger) -> StreamingQuery:
    """Apply each micro-batch to the graph at path, in order of seq within it.

    Version k + 1 is made from version k by batch k, so a batch that runs again after a failure writes the same delta
    again. on_batch(batch_id, graph, touched, rejected) sees each result.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new, touched, rejected = apply_batch(spark, path, batch_id, batch)
        if (batch_id + 1) % compact_every == 0:
            compact(spark, path, batch_id + 1)
        if on_batch:
            on_batch(batch_id, new, touched, rejected)

    return edits.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def freshness(edits: DataFrame) -> DataFrame:
    """The time of the last edit."""
    return edits.agg(F.max("ts").alias("last_edit"))
