"""Operator 4, LM scoring: stupid-backoff scores of all texts by n-gram counts over all texts.

Texts are encoded in chunks: a chunk holds its distinct n-grams of each order (64-bit hashes) once, with the
counts within the chunk. Those explode into count tables that are partitioned by hash, one row per chunk and
hash bucket; a bucket sums the counts of all chunks and hands each chunk its n-grams' totals. Chunks are joined
to these totals, and the scores of their n-grams are summed per text. An n-gram that stands in a third of all
texts is still one entry per chunk, so no bucket is hot. Chunks are written once, bucketed by their id, so the
join does not move them again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonweave.llm._hashing import drop_caches, hashed_words, joined, packed, slices, squeezed, unpacked, unsqueezed
from axonweave.llm._tables import store_bucketed

#: Words of a chunk, about; and n-grams of a bucket, about.
CHUNK_WORDS = 1_500_000
BUCKET_GRAMS = 2_000_000
#: Scores are sums of log10 in millionths, so that any order of summing gives the same result.
UNIT = 1_000_000

CHUNK = "chunk long, words long, docs binary, unnamed binary, lengths binary, stream binary, vocabulary binary"


def _encoded(docs: DataFrame) -> DataFrame:
    """Chunks of texts: ids of the documents, their lengths, and their words as places in a local vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        rows, words, at = [], 0, 0

        def chunk() -> pa.RecordBatch:
            stream = np.concatenate([r[3] for r in rows])
            vocabulary, place, counts = np.unique(stream, return_inverse=True, return_counts=True)
            by_count = np.argsort(-counts, kind="stable")  # small places for frequent words
            rank = np.empty(len(by_count), np.uint64)
            rank[by_count] = np.arange(len(by_count))
            ids, unnamed, lengths = (np.concatenate([r[k] for r in rows]) for k in range(3))
            values = [(TaskContext.get().partitionId() << 32) + at, len(stream), ids.astype(np.int64).tobytes(), unnamed.tobytes(), lengths.astype(np.int32).tobytes(), squeezed(rank[place]), vocabulary[by_count].tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i < 2 else pa.binary()) for i, v in enumerate(values)], names=[c.split()[0] for c in CHUNK.split(", ")])

        for whole in batches:
            for batch in slices(whole):
                hashes, counts = hashed_words(batch.column("text"))
                ids = batch.column("doc_id")
                rows.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), counts, hashes))
                words += len(hashes)
                if words >= CHUNK_WORDS:
                    yield chunk()
                    rows, words, at = [], 0, at + 1
        if rows:
            yield chunk()

    return docs.mapInArrow(run, CHUNK)


def _grams(stream: np.ndarray, lengths: np.ndarray, vocabulary: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For all orders: distinct hashes, sorted; the place among them of the n-gram that ends at each word
    (-1: its text has too few words before it); and their counts."""
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(len(stream)) - np.repeat(first, lengths)
    words = vocabulary[stream]
    sort = np.argsort(vocabulary)
    place = np.empty(len(sort), np.int64)
    place[sort] = np.arange(len(sort))
    out = [(vocabulary[sort], place[stream], np.bincount(stream, minlength=len(sort))[sort])]
    grown = words
    for n in range(2, order + 1):
        grown = np.concatenate([np.zeros(min(1, len(words)), np.uint64), joined(grown[:-1], words[1:])])
        full = within >= n - 1
        hashes, place, counts = np.unique(grown[full], return_inverse=True, return_counts=True)
        ends = np.full(len(stream), -1, np.int64)
        ends[full] = place
        out.append((hashes, ends, counts))
    return out


def _parts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return unsqueezed(row["stream"]).astype(np.int64), np.frombuffer(row["lengths"], np.int32), np.frombuffer(row["vocabulary"], np.uint64)


def _entries(chunks: DataFrame, order: int, buckets: int) -> DataFrame:
    """A row per chunk, order and bucket that has n-grams: their sorted hashes and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            for row in batch.to_pylist():
                stream, lengths, vocabulary = _parts(row)
                out = []
                for n, (hashes, _, counts) in enumerate(_grams(stream, lengths, vocabulary, order), 1):
                    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)  # in the order of hashes
                    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(hashes)]
                    out += [(row["chunk"], n, int(bucket[i]), packed(hashes[i:j]), squeezed(counts[i:j])) for i, j in zip(cuts, cuts[1:]) if j > i]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["chunk", "n", "bucket", "hashes", "counts"])

    return chunks.select("chunk", "lengths", "stream", "vocabulary").mapInArrow(run, "chunk long, n int, bucket int, hashes binary, counts binary")


def _totals(rows: pd.DataFrame) -> pd.DataFrame:
    """The corpus count of each entry of one bucket."""
    hashes = [unpacked(h) for h in rows["hashes"]]
    _, place = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = np.bincount(place, weights=np.concatenate([unsqueezed(c) for c in rows["counts"]]))
    cuts = np.cumsum([len(h) for h in hashes])[:-1]
    return pd.DataFrame({"chunk": rows["chunk"], "n": rows["n"], "bucket": rows["bucket"], "totals": [squeezed(p) for p in np.split(sums[place], cuts)]})


def _log(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1))


def _own(owner: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How often the n-gram that ends at each word occurs in that word's text."""
    _, place, times = np.unique((owner << 32) + ends, return_inverse=True, return_counts=True)
    return times[place]


def backoff_scores(docs: DataFrame, order: int = 3, least: int = 1, alpha: float = 0.4, apart: bool = True) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_seen, score; a row for each row of docs.

    Words are runs of characters other than space and \\t to \\r, A-Z lower-cased. Counts c are over all texts; with
    apart, over all texts but the one that is scored, as a text that counts itself never backs off. A word's score
    is log10 of c(its n-gram) / c(the n-gram without it), from the highest order at which the n-gram occurs least
    times or more; each step down costs log10(alpha); at one word it is c(word), or 1, / all words. A text's first
    words have shorter n-grams and no cost for that. score is the sum over the text's words in millionths, each
    rounded (half up); n_seen counts the words whose longest n-gram occurs least times or more.
    Null and empty texts have 0 words and score 0. Repeated rows are texts of their own and count for each other;
    texts of any length are read whole; other columns are ignored; an empty table gives no rows. n-grams are told
    apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = store_bucketed(_encoded(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))), "chunk", parts)
    words = chunks.agg(F.sum("words")).first()[0] or 0
    buckets = max(parts, -(-words * order // BUCKET_GRAMS))
    entries = _entries(chunks, order, buckets)
    totals = entries.groupBy("bucket", "n").applyInPandas(_totals, "chunk long, n int, bucket int, totals binary")
    cost = float(np.log10(alpha))

    def score(key: tuple, chunk: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        stream, lengths, vocabulary = _parts(row)
        found = found.sort_values(["n", "bucket"])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        rest = words - (lengths.astype(np.int64)[owner] if apart else 0)
        value, reach, before = np.zeros(len(stream)), np.zeros(len(stream), np.int64), None
        for n, (_, ends, _) in enumerate(_grams(stream, lengths, vocabulary, order), 1):
            counts = np.concatenate([np.zeros(0), *(unsqueezed(b) for b in found.loc[found["n"] == n, "totals"])])
            can = ends >= 0
            count = np.where(can, counts[np.maximum(ends, 0)] if len(counts) else 0, 0)
            if apart:
                count = np.where(can, count - _own(owner, ends), 0)
            seen = can & (count >= least)
            if n == 1:
                value = _log(count) - _log(rest)
            else:
                value = np.where(seen, _log(count) - _log(before), value + np.where(can, cost, 0))
            reach = np.where(can, seen, reach)
            before = np.concatenate([np.ones(min(1, len(stream))), count[:-1]])  # of the n-gram that ends a word earlier
        units = np.floor(value * UNIT + 0.5).astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(lengths)])

        def sums(x: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(x)])[edge])

        ids = pd.arrays.IntegerArray(np.frombuffer(row["docs"], np.int64).copy(), np.frombuffer(row["unnamed"], bool).copy())
        return pd.DataFrame({"doc_id": ids, "n_words": lengths.astype(np.int64), "n_seen": sums(reach.astype(np.int64)), "score": sums(units)})

    return chunks.select("chunk", "docs", "unnamed", "lengths", "stream", "vocabulary").groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInPandas(score, "doc_id long, n_words long, n_seen long, score long")
