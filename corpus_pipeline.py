"""From raw documents to packed training sequences, in five stages.

Each stage reads all that its predecessor kept, from Parquet, and all but the last return rows with the columns
of documents: the quality classifier drops documents it rejects, the Jaccard join leaves one document of each
group of near copies, decontamination drops contaminated documents, personal data is masked in the texts, and
best-fit packing places what is left into sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonweave.llm._tables import read_table, shared_dir, store
from axonweave.llm.decontamination import contamination
from axonweave.llm.jaccard import jaccard_components
from axonweave.llm.packing import pack_documents
from axonweave.llm.pii import masked
from axonweave.llm.quality import selected


#: Near copies: words of a shingle, and the least share of shingles in common, of those in either text.
WIDTH, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is one half or more, by labels(doc_id, quality, toxic).

    Each row is judged by its own text, so rows that share a doc_id are judged one by one and repeated rows share
    their fate. A null text counts as empty and is scored so; texts are read whole. Without usable labels all rows
    stay. Columns beyond those of documents go along; an empty table stays empty.
    """
    return selected(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id (null last), then the smallest
    hash of the whole row.

    Nodes are texts, not ids: two texts under one doc_id are two nodes, and rows without a doc_id are compared like
    all others. Rows that repeat in every column are one document. Texts that are null or have no word are copies
    of nothing, so all of them stay. Columns beyond those of documents go along; an empty table stays empty.
    """
    kinds = dict(docs.dtypes)
    whole = F.xxhash64(*(F.to_json(F.struct(c)) if "map<" in kinds[c] or kinds[c] == "variant" else F.col(c) for c in docs.columns))  # maps have no hash
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # The row is one column, so that no column of docs has the name of a helper.
    every = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("text_key"), whole.alias("row_key"), worded.alias("worded"))
    keyed = every.where("worded")
    links = jaccard_components(keyed.select(F.col("text_key").alias("doc_id"), F.col("row.text").alias("text")), width=WIDTH, percent=PERCENT)
    groups = links.select(F.col("doc_id").alias("text_key"), F.col("component_id").alias("group")).distinct()
    # Copies are counted before the join, so a text that a third of all rows share is one row in it.
    order = F.struct(F.col("row.doc_id").isNull().alias("a"), F.col("row.doc_id").alias("b"), F.col("row_key").alias("c"))
    first = keyed.groupBy("text_key").agg(F.min(order).alias("m")).join(groups, "text_key").groupBy("group").agg(F.min("m").alias("m")).select(F.col("m.c").alias("row_key"))
    times = keyed.groupBy("row_key").agg(F.count("*").alias("times")).join(first, "row_key", "left_semi")
    kept = keyed.join(store(times), "row_key")
    once = kept.where("times = 1").select("row").unionByName(kept.where("times > 1").dropDuplicates(["row_key"]).select("row"))
    return once.unionByName(every.where("NOT worded").select("row")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not contaminated by items of benchmark(item_id, text).

    The decision is the text's, whatever its doc_id: a contaminated text without an id goes, and a clean text that
    shares an id with a contaminated one stays. Null and empty texts have no words and stay; repeated rows share
    their fate; texts are read whole. Columns beyond those of documents go along; an empty table stays empty.
    """
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("text_key"))
    judged = contamination(keyed.select(F.col("text_key").alias("doc_id"), F.col("row.text").alias("text")), read_table(spark, sf_dir, "benchmark"))
    bad = judged.where("contaminated").select(F.col("doc_id").alias("text_key")).distinct()
    return keyed.join(bad, "text_key", "left_anti").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked; n_chars follows the text.

    Rows are matched to their findings by doc_id (null too) and text, so rows that share an id keep their own
    texts, and repeated rows stay as often as they occur. A null text stays null with its n_chars. Columns beyond
    those of documents go along; an empty table stays empty.
    """
    hidden = masked(docs)
    return hidden.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 tokens.

    A null text is empty and has the end token alone; a null doc_id is kept as null; repeated rows are packed as
    often as they occur; other columns do not go along. An empty table has no pieces.
    """
    return pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; what lies between them is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs


#: The first and the last stage cannot be said in SQL; tests hold the others against brute force.
ORACLE_SQL = None
