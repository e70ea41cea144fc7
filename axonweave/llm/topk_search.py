"""Operator 3, exact top-k search: three phases with one uniform threshold over several score lists.

A vector's components are dealt to lists; a list's entry for a query and a candidate is the inner product over
its components, and the score is the sum of a candidate's entries.

1. Each block of candidates gathers the best entries of one of its lists, the one in which the queries are
   strongest, and the first of the others, and resolves these few. The k-th best score of a query among them is a
   safe cutoff.
2. The cutoffs are sent with the queries. A candidate that reaches the cutoff has an entry of cutoff / lists or
   more in some list. Lists are sorted by the candidates' norms over their components, and norms bound entries, so
   only the head of a list is multiplied; a candidate whose norms bound its score below the cutoff is left out.
3. The scores of the entries that reach the threshold are resolved exactly and ranked.

Blocks are stored once, in groups; a task reads some of candidates and some of queries, and pairs them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from axonweave.llm._tables import store

#: Vectors of a block, at most; queries that are scored at once; and full blocks that one task stores, at most.
QUERIES, CANDIDATES, STEP, GROUP = 2048, 4096, 256, 64
LISTS = 4
#: Entries that phase 1 gathers for a query, for each of the k that are wanted; more of them raise the cutoff.
HEAD = 8
#: Components from here on are kept apart, in blocks whose scores are summed without rounding.
LARGE = 2.0**31
LOWEST, HIGHEST = -(2**63), 2**63 - 1
#: Norms and entries are compared as doubles; bounds are widened by this share, far more than rounding takes.
SLACK = 1e-9


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows (ids, dims, data) of at most size vectors each, dealt evenly whatever their ids. Vectors with very large
    components have blocks of their own."""

    def pack(rows: list) -> pa.RecordBatch:
        ids, vectors = zip(*rows)
        matrix = np.zeros((len(ids), max(map(len, vectors))), np.float64)
        for i, v in enumerate(vectors):
            matrix[i, : len(v)] = v
        return pa.RecordBatch.from_arrays([pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([matrix.shape[1]], pa.int32()), pa.array([_narrow(matrix).tobytes()], pa.binary())], names=["ids", "dims", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[bool, list] = {False: [], True: []}
        for b in batches:
            for i, v in zip(b.column("vec_id").to_pylist(), b.column("v").to_pylist()):
                rows = open_[any(abs(x) >= LARGE for x in v)]
                rows.append((i, v))
                if len(rows) == size:
                    yield pack(rows)
                    rows.clear()
        yield from (pack(rows) for rows in open_.values() if rows)

    blocks = -(-vectors.count() // size)
    parts = max(min(blocks, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))), -(-blocks // GROUP), 1)
    return store(vectors.withColumn("v", F.transform("v", lambda x: x * 256.0)).repartition(parts).mapInArrow(run, "ids binary, dims int, data binary").withColumn("block", F.monotonically_increasing_id()))


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """Whole numbers, in 32 bits if they fit."""
    matrix = np.floor(matrix)
    return matrix.astype(np.int32) if np.abs(matrix).max(initial=0) < LARGE else matrix


def _matrix(data: bytes, n: int, dims: int, width: int) -> np.ndarray:
    kind = np.float64 if n * dims and len(data) == 8 * n * dims else np.int32
    return np.pad(np.frombuffer(data, kind).reshape(n, dims).astype(np.float64), ((0, 0), (0, width - dims)))


def _pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per query block and candidate block. Each task reads the blocks that it pairs as they are stored: none is dealt
    anew, and none passes through the driver, as query blocks would that are broadcast."""
    q = queries.select(F.col("block").alias("qb"), F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"), F.col("data").alias("q_data"), *(c for c in queries.columns if c == "cutoffs"))
    c = candidates.select(F.col("ids").alias("c_ids"), F.col("dims").alias("c_dims"), F.col("data").alias("c_data"))
    return c.hint("shuffle_replicate_nl").crossJoin(q)


class Pair:
    """A block of queries against a block of candidates. work counts the products of components that were made."""

    def __init__(self, q: np.ndarray, c: np.ndarray, lists: int):
        self.q, self.c, self.work = q, c, 0
        self.cuts = [cut for cut in np.array_split(np.arange(q.shape[1]), lists) if len(cut)]
        with np.errstate(over="ignore"):
            norm = lambda m: np.stack([np.sqrt((m[:, cut] ** 2).sum(axis=1)) for cut in self.cuts], axis=1)
            self.q_norm, self.c_norm = norm(q), norm(c)
        #: candidates by falling norm, per list
        self.order = [np.argsort(-self.c_norm[:, k], kind="stable") for k in range(len(self.cuts))]
        bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
        self.exact_in = np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object

    def scores(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Exact scores of some pairs; those beyond 64 bits become the nearest 64-bit number."""
        self.work += len(rows) * self.q.shape[1]
        if self.exact_in is not object:
            out = np.empty(len(rows), np.int64)
            for at in range(0, len(rows), 1 << 16):
                a, b = (m[i[at : at + (1 << 16)]].astype(self.exact_in) for m, i in ((self.q, rows), (self.c, columns)))
                out[at : at + (1 << 16)] = np.einsum("ij,ij->i", a, b)
            return out
        whole = lambda v: [int(x) for x in v]
        sums = (sum(x * y for x, y in zip(whole(self.q[r]), whole(self.c[c]))) for r, c in zip(rows, columns))
        return np.array([min(max(s, LOWEST), HIGHEST) for s in sums], np.int64)

    def heads(self, at: int, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Phase 1: for some queries, the pairs with the best entries of one list, and with the first of all lists."""
        rows = slice(at, at + len(own))
        cut = self.cuts[int(self.q_norm[rows].sum(axis=0).argmax())]
        entries = self._entries(rows, cut, self.c)
        entries[own] = -np.inf
        n = min(HEAD * k, entries.shape[1])
        found = np.zeros(own.shape, bool)
        np.put_along_axis(found, np.argpartition(-entries, n - 1, axis=1)[:, :n], True, axis=1)
        for order in self.order:
            found[:, order[: 2 * k]] = True
        return np.nonzero(found & ~own)

    def reaching(self, at: int, own: np.ndarray, cutoffs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phase 2: pairs with an entry of cutoff / lists or more, in any list. Phase 3: their scores, which are the
        sum of their entries where all lists were read so far, and are resolved where not."""
        rows = slice(at, at + len(own))
        lists = len(self.cuts)
        found, read = np.zeros(own.shape, bool), np.zeros(own.shape, np.int16)
        total = np.zeros(own.shape)
        need = (cutoffs - np.abs(cutoffs) * SLACK - 1) / lists
        for k, cut in enumerate(self.cuts):
            norm = self.c_norm[self.order[k], k]
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                least = np.where(need <= 0, -np.inf, need / (self.q_norm[rows, k] * (1 + SLACK)))  # the least norm that can reach
            live = np.flatnonzero(least <= norm[:1].max(initial=-np.inf))
            if not len(live):
                continue
            head = self.order[k][: np.searchsorted(-norm, -least[live].min(), "right")]
            entries = self._entries(at + live, cut, self.c[head])
            with np.errstate(over="ignore", invalid="ignore"):
                off = 0.0 if self.exact_in is np.float64 else np.nan_to_num(1e-12 * len(cut) * self.q_norm[at + live, k] * norm[0], nan=np.inf)  # what rounding may take
                found[np.ix_(live, head)] |= ~(entries < (need[live] - off)[:, None])
                total[np.ix_(live, head)] += entries
            read[np.ix_(live, head)] += 1
        with np.errstate(over="ignore", invalid="ignore"):
            most = (self.q_norm[rows] @ self.c_norm.T) * (1 + SLACK)
        r, c = np.nonzero(found & ~own & ~(most < (cutoffs - np.abs(cutoffs) * SLACK - 1)[:, None]))
        full = (read[r, c] == lists) & (self.exact_in is np.float64)
        scores = np.empty(len(r), np.int64)
        scores[full] = total[r[full], c[full]]
        scores[~full] = self.scores(r[~full] + at, c[~full])
        return r, c, scores

    def _entries(self, rows, cut: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        q = self.q[rows][:, cut]
        self.work += len(q) * len(cut) * len(candidates)
        with np.errstate(over="ignore", invalid="ignore"):
            entries = q @ candidates[:, cut].T
        return np.where(np.isnan(entries), np.inf, entries)  # beyond doubles: cannot be left out


def _best(rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k highest scores, ties to smaller ids."""
    order = np.lexsort((ids[columns], ~scores, rows))  # ~x falls as x rises, and never overflows
    place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
    return order[place < k]


FOUND = "qb long, place int, query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, lists: int = LISTS) -> DataFrame:
    """vectors(vec_id, embedding) -> query_id, rank, vec_id, score: each query's k highest scores, or all if fewer.

    Components become floor(256 * x); the score is the integer inner product, shorter vectors being filled up
    with 0; a score beyond 64 bits is the nearest 64-bit number. Ties go to the smaller vec_id. A query's candidates
    are the rows with other vec_ids. Vectors that are null or hold null or non-finite components (256 * x overflows:
    too), and rows without vec_id, take no part. Repeated rows are candidates and queries as often as they occur.
    Vectors of any length are used whole; other columns are ignored; an empty table gives no rows.
    """
    fit = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * 256.0) < float("inf"))) & F.col("vec_id").isNotNull()
    clean = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"), is_query.alias("is_query")).where(fit)
    queries, candidates = _blocks(clean.where("is_query").drop("is_query"), QUERIES), _blocks(clean.drop("is_query"), CANDIDATES)

    def search(safe: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    q_ids, c_ids = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.c_ids, np.int64)
                    width = max(row.q_dims, row.c_dims, 1)
                    pair = Pair(_matrix(row.q_data, len(q_ids), row.q_dims, width), _matrix(row.c_data, len(c_ids), row.c_dims, width), lists)
                    cutoffs = np.full(len(q_ids), -np.inf)
                    for x in row.cutoffs if safe and row.cutoffs is not None else []:
                        cutoffs[x["place"]] = x["cutoff"]
                    for at in range(0, len(q_ids), STEP):
                        own = q_ids[at : at + STEP, None] == c_ids[None, :]
                        cut = cutoffs[at : at + STEP]
                        if safe:
                            r, c, scores = pair.reaching(at, own, cut)
                        else:
                            r, c = pair.heads(at, own, k)
                            scores = pair.scores(r + at, c)
                        kept = _best(r, c, scores, c_ids, k)
                        r, c, scores = r[kept], c[kept], scores[kept]
                        yield pd.DataFrame({"qb": np.full(len(r), row.qb), "place": (r + at).astype(np.int32), "query_id": q_ids[r + at], "vec_id": c_ids[c], "score": scores})

        return run

    by_query = Window.partitionBy("qb", "place").orderBy(F.desc("score"), "vec_id")
    heads = _pairs(queries, candidates).mapInPandas(search(False), FOUND).withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") == k)
    cutoffs = heads.groupBy("qb").agg(F.collect_list(F.struct("place", F.col("score").alias("cutoff"))).alias("cutoffs"))  # one for each query of a block
    safe = store(queries.join(cutoffs, queries.block == cutoffs.qb, "left").drop("qb"))
    found = _pairs(safe, candidates).mapInPandas(search(True), FOUND)
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
