"""Operator 1, quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= j) is the logistic function of threshold j minus a text's latent score; the score is a sum of weights
that all grades share, one per hashed feature of the text, and the thresholds are ordered by construction. The
expected grade and the tail probability of the best grade follow. The model is fitted on a bounded sample of
the rated texts; every text is scored from all of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonweave.llm._hashing import WHITE, distinct, drop_caches, hashed_prefixes, hashed_words, mix, slices, utf8
from axonweave.llm._tables import store

BITS = 20
#: At most so many rated texts are fitted on.
SAMPLE = 4096
#: Features of fewer texts of the sample have no weight.
LEAST_TEXTS = 3
_BYTE = np.arange(256)
_ALNUM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_CAPITAL = (_BYTE >= 65) & (_BYTE <= 90)
#: Lengths in bytes of the beginnings of words that are features besides whole words.
STEMS = (4, 6, 8)
#: A feature that occurs so often is a further feature.
OFTEN = (2, 3, 5)
#: Bytes that part runs of punctuation.
_NO_MARK = _ALNUM | WHITE | (_BYTE < 32)
_SHARES = np.array([0.01, 0.03, 0.1, 0.2, 0.4, 0.6, 0.8, 0.95])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashed features, flat, and how many: its words (a-z, digits and letters beyond) and
    their beginnings, its runs of punctuation, and the sizes, in steps, of its shares of capitals, punctuation and repeated words."""
    data, offsets = utf8(texts)
    (words, *stems), n_words = hashed_prefixes(texts, ~_ALNUM, STEMS)
    marks, n_marks = hashed_words(texts, _NO_MARK)
    n = len(texts)
    sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    letters = np.maximum(sums(_ALNUM[data]), 1)
    owner = np.repeat(np.arange(n, dtype=np.uint64), n_words)
    mask = np.uint64((1 << BITS) - 1)
    shift = np.uint64(BITS)
    different = np.bincount((distinct((owner << np.uint64(40)) | (words >> np.uint64(24))) >> np.uint64(40)).astype(np.int64), minlength=n)
    shares = [sums(_CAPITAL[data]) / letters, n_marks / np.maximum(n_words, 1), sums(~_NO_MARK[data]) / letters, 1 - different / np.maximum(n_words, 1)]
    steps = [mix(np.searchsorted(_SHARES, s).astype(np.uint64) + np.uint64(100 * k + 1)) for k, s in enumerate(shares)]
    keys = [*((owner << shift) | (w & mask) for w in (words, *stems)), (np.repeat(np.arange(n, dtype=np.uint64), n_marks) << shift) | (mix(marks) & mask)]
    keys += [(np.arange(n, dtype=np.uint64) << shift) | (s & mask) for s in steps]
    keys, times = np.unique(np.concatenate(keys), return_counts=True)
    often = [(k & ~mask) | (mix((k & mask) + (np.uint64(t) << shift)) & mask) for t in OFTEN for k in (keys[times >= t],)]
    keys = distinct(np.concatenate([keys, *often]))
    return (keys & mask).astype(np.int64), np.bincount((keys >> shift).astype(np.int64), minlength=n)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class CumulativeLink:
    """Weights per feature, and one threshold fewer than grades."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    @classmethod
    def constant(cls, grades: np.ndarray, n_grades: int) -> CumulativeLink:
        """The model that gives every text the shares of the grades."""
        n = len(grades)
        share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(n, 1), 0.5 / (n + 1), 1 - 0.5 / (n + 1))
        return cls(np.zeros(1 << BITS), np.log(share / (1 - share)) + 1e-9 * np.arange(n_grades - 1))

    def _ends(self, s: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(grade <= own) and P(grade < own) at scores s."""
        return _sigmoid(np.append(self.thresholds, np.inf)[grades] - s), _sigmoid(np.insert(self.thresholds, 0, -np.inf)[grades] - s)

    def slopes(self, s: np.ndarray, grades: np.ndarray) -> np.ndarray:
        """The loss's slopes in the scores."""
        upper, lower = self._ends(s, grades)
        return 1 - upper - lower

    def refine(self, rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, ridge: float = 0.1, steps: int = 300) -> np.ndarray:
        """Penalised maximum likelihood over the features in columns (entries of texts in rows), by accelerated
        gradient steps under a diagonal bound of the curvature. Returns the texts' scores."""
        n, n_grades = len(grades), len(self.thresholds) + 1
        used = np.flatnonzero(np.bincount(columns, minlength=1 << BITS))
        place = np.zeros(1 << BITS, np.int32)
        place[used] = np.arange(len(used))
        c = place[columns]
        width = np.bincount(rows, minlength=n) + 1.0
        bound = 0.25 * np.bincount(c, weights=width[rows], minlength=len(used)) + ridge
        w = last = self.weights[used]
        for t in range(steps):
            look = w + t / (t + 3) * (w - last)
            upper, lower = self._ends(np.bincount(rows, weights=look[c], minlength=n), grades)
            last, w = w, look - (np.bincount(c, weights=(1 - upper - lower)[rows], minlength=len(used)) + ridge * look) / bound
            p = np.maximum(upper - lower, 1e-9)
            slope, curve = np.zeros(n_grades - 1), np.full(n_grades - 1, 1.0)
            for k in range(n_grades - 1):
                under, over = grades == k, grades == k + 1
                slope[k] = np.sum((lower * (1 - lower) / p)[over]) - np.sum((upper * (1 - upper) / p)[under])
                curve[k] += np.sum((upper * (1 - upper))[under]) + np.sum((lower * (1 - lower))[over])
            self.thresholds = np.maximum.accumulate(self.thresholds - np.clip(0.5 * slope / curve, -0.2, 0.2)) + 1e-9 * np.arange(n_grades - 1)
        self.weights[used] = w
        return np.bincount(rows, weights=w[c], minlength=n)

    def predict(self, columns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the best grade of each text."""
        s = np.bincount(np.repeat(np.arange(len(counts)), counts), weights=self.weights[columns], minlength=len(counts))
        above = _sigmoid(s[:, None] - self.thresholds[None, :])
        return above.sum(axis=1), above[:, -1]


def _graded(labels: DataFrame) -> DataFrame:
    """One grade per document, 0 to 2: a point each for good quality and for not being toxic. Of several ratings
    the worst counts; ratings with a null are left out."""
    rated = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return rated.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min(F.col("quality").cast("int")) + 1 - F.max(F.col("toxic").cast("int"))).alias("grade"))


def _entries_of(table: DataFrame, wanted: np.ndarray) -> DataFrame:
    """doc_id and, as bytes of 32-bit numbers, those of its features that are wanted."""
    shared = table.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for b in batches:
            lists = [x.values.to_numpy() for x in b.column("columns")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x[shared.value[x]].tobytes() for x in lists], pa.binary())], names=["doc_id", "columns"])

    return table.select("doc_id", "columns").mapInArrow(run, "doc_id long, columns binary")


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_z: float = 3.5) -> CumulativeLink | None:
    """Fit on at most sample rated documents, taken by the smallest hashes of their ids; None if there are none.

    Of several rows with one id the smallest text counts. A feature gets a weight if its score test exceeds least_z: first against constant grades, then against the fit
    so far. The tests are aggregations over the sample's features in Spark; the driver sees the entries of tested
    features only.
    """
    chosen = _graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for whole in batches:
            for batch in slices(whole):
                columns, counts = features(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(columns.astype(np.int32)))], names=["doc_id", "grade", "columns"])

    table = store(rows.select("doc_id", "grade", "text").mapInArrow(run, "doc_id long, grade int, columns array<int>"))
    rated = table.select("doc_id", "grade").toPandas().sort_values("doc_id")
    if not len(rated):
        return None
    grades = rated["grade"].to_numpy().astype(np.int64)
    ids = rated["doc_id"].to_numpy()
    entries = table.select("doc_id", F.explode("columns").alias("column"))
    model = CumulativeLink.constant(grades, 3)
    s = np.zeros(len(ids))
    for _ in range(2):
        slopes = model.slopes(s, grades)
        by_doc = F.broadcast(docs.sparkSession.createDataFrame(pd.DataFrame({"doc_id": ids, "slope": slopes})))
        tests = entries.join(by_doc, "doc_id").groupBy("column").agg(F.count("*").alias("n"), F.sum("slope").alias("t"))
        z = F.abs(F.col("t")) / F.sqrt(F.col("n") * float(max(np.mean(slopes**2), 1e-12)))
        known = np.flatnonzero(model.weights)
        tested = tests.where((F.col("n") >= LEAST_TEXTS) & (z >= least_z)).select("column").toPandas()["column"].to_numpy()
        wanted = np.zeros(1 << BITS, bool)
        wanted[known] = wanted[tested] = True
        if not wanted.any():
            break
        found = sorted(_entries_of(table, wanted).collect(), key=lambda r: r.doc_id)
        columns = np.frombuffer(b"".join(r.columns for r in found), np.int32)
        s = model.refine(np.repeat(np.arange(len(ids), dtype=np.int32), [len(r.columns) // 4 for r in found]), columns, grades)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, quality, toxic) -> doc_id, expected_grade, tail_prob, keep; a row for
    each row of docs.

    tail_prob is the probability of the best grade (good and not toxic); keep says whether it reaches least.
    Null and empty texts have no words and are scored so. Without usable labels every text has the middle
    grade and is kept. Of several rated rows with one id the smallest text is fitted on, so the fit is always the
    same. Texts are read whole. Repeated rows get equal results; other columns are ignored; an empty table gives no rows.
    """
    model = fit_quality(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        model = shared.value
        for whole in batches:
            for batch in slices(whole):
                n = batch.num_rows
                grade, tail = model.predict(*features(batch.column("text"))) if model else (np.ones(n), np.ones(n))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(grade, 6)), pa.array(np.round(tail, 6)), pa.array(tail >= least)], names=["doc_id", "expected_grade", "tail_prob", "keep"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, expected_grade double, tail_prob double, keep boolean")


def selected(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that quality_scores keeps, with all their columns."""
    model = fit_quality(docs, labels, sample)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for whole in batches:
            for batch in slices(whole):
                yield batch.filter(pa.array(shared.value.predict(*features(batch.column("text")))[1] >= least))

    return docs.mapInArrow(run, docs.schema)
