"""The registered queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonweave.llm import oracles, url_filter
from axonweave.llm._tables import read_table
from axonweave.llm.conversations import structure_repair
from axonweave.llm.decontamination import contamination
from axonweave.llm.html_extraction import extract
from axonweave.llm.jaccard import jaccard_components
from axonweave.llm.language_id import identify
from axonweave.llm.lm_scoring import backoff_scores
from axonweave.llm.packing import pack_documents
from axonweave.llm.pii import digest, personal_data
from axonweave.llm.quality import quality_scores
from axonweave.llm.secrets import scan
from axonweave.llm.spelling import spelling_variants
from axonweave.llm.topk_search import top_k

Query = Callable[[SparkSession, str], DataFrame]


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op3_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(read_table(spark, sf_dir, "documents"))


def op5_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def op8_hierarchical_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op9_tag_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op10_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(personal_data(read_table(spark, sf_dir, "documents")))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages")).drop("score")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair(read_table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ordinal_quality,
        op2_sum_of_squares_packing,
        op3_threshold_topk,
        op4_stupid_backoff,
        op5_jaccard_components,
        op6_positional_decontamination,
        op7_entropy_secrets,
        op8_hierarchical_langid,
        op9_tag_path_extraction,
        op10_bootstrapped_pii,
        op11_url_filters,
        op12_structure_repair,
        op13_spelling_variants,
    )
}

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = oracles.SQL | {
    "op3_threshold_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op4_stupid_backoff": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        t AS (
            SELECT r, i, len(w) AS n, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a
            FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
        o AS (
            SELECT r, i, n, count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY r, c) AS o1,
                CASE WHEN i > 1 THEN count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY r, b, c) ELSE 0 END AS o2,
                CASE WHEN i > 2 THEN count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY r, a, b, c) ELSE 0 END AS o3 FROM t),
        x AS (SELECT *, lag(o1) OVER w AS p1, lag(o2) OVER w AS p2 FROM o WINDOW w AS (PARTITION BY r ORDER BY i)),
        v1 AS (SELECT *, log10(greatest(o1, 1)) - log10(greatest((SELECT count(*) FROM t) - n, 1)) AS v FROM x),
        v2 AS (SELECT * REPLACE (CASE WHEN o2 >= 1 THEN log10(o2) - log10(p1) WHEN i > 1 THEN v + log10(0.4) ELSE v END AS v) FROM v1),
        v3 AS (SELECT * REPLACE (CASE WHEN o3 >= 1 THEN log10(o3) - log10(p2) WHEN i > 2 THEN v + log10(0.4) ELSE v END AS v) FROM v2),
        sums AS (
            SELECT r, CAST(count_if(CASE WHEN i > 2 THEN o3 WHEN i > 1 THEN o2 ELSE o1 END >= 1) AS BIGINT) AS n_seen,
                CAST(sum(CAST(floor(v * 1000000 + 0.5) AS BIGINT)) AS BIGINT) AS score FROM v3 GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_seen, 0) AS n_seen, coalesce(score, 0) AS score
        FROM d LEFT JOIN sums USING (r)""",
    "op5_jaccard_components": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
                ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS s FROM words),
        long AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingles),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM long a JOIN long b ON a.x = b.x AND a.doc_id <> b.doc_id
            WHERE a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM shingles JOIN least USING (doc_id)""",
    "op6_positional_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, w[i:i + 12] AS p, len(w[i:i + 12]) AS n
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM windows),
        spots AS (
            SELECT doc_id, i, n, w[i:i + n - 1] AS p
            FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS i FROM d, sizes)),
        found AS (SELECT doc_id, i, s.n, item_id FROM spots s JOIN windows USING (p)),
        hits AS (
            SELECT doc_id, count(DISTINCT k) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
}
