"""Operator 8, language identification by hierarchical discrimination.

Linear support vector machines on the frequencies of hashed byte trigrams first tell language families apart,
then, one language against one other, the languages within the family. A machine's value for a text is the mean
of its trigrams' weights, so whole texts of any length are read in one pass over their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from axonweave.llm._hashing import drop_caches, slices, utf8

#: Fitted on so many texts of each language at most.
SAMPLE = 400
BITS = 14
#: The table of languages is sent to every task if it has no more rows.
BROADCAST_LANGS = 10_000
# Language codes by family; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg sr hr bs sl mk pl cs sk",
    "uralic": "fi et hu",
    "turkic": "tr az uz kk tk",
    "indic": "hi ur bn pa mr gu ne",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_BYTE = np.arange(256)
_FOLD = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, np.where((_BYTE >= 97) & (_BYTE <= 122) | (_BYTE >= 128), _BYTE, 32)).astype(np.uint32)
_LATIN = (_FOLD >= 97) & (_FOLD <= 122)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts, flat, and how many each text has. Letters are small; all else is space."""
    data, offsets = utf8(texts)
    x = _FOLD[data]
    n = np.maximum(np.diff(offsets) - 2, 0)
    if len(x) < 3:
        return np.zeros(0, np.int64), n
    code = (x[:-2] * np.uint32(65_599) + x[1:-1]) * np.uint32(65_599) + x[2:]
    code = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
    last = np.zeros(len(data) + 2, bool)  # trigrams must end within their text
    for k in (1, 2):
        ends = offsets[1:][np.diff(offsets) >= 1] - k
        last[ends[ends >= 0]] = True
    return code[~last[: len(code)]], n


def _lettered(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter."""
    data, offsets = utf8(texts)
    some = np.diff(np.concatenate([[0], np.cumsum(_LATIN[data])])[offsets]) > 0
    for i in np.flatnonzero(~some & (np.diff(offsets) > 0)):
        some[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return some


def _svm(x: np.ndarray, scale: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss on scaled columns, by accelerated gradient
    steps. y is 1, -1, or 0 for rows that take no part; x is never copied."""
    share = cost * 0.5 * ((y > 0) / max((y > 0).sum(), 1) + (y < 0) / max((y < 0).sum(), 1))

    def value(w: np.ndarray) -> np.ndarray:
        return x @ (scale * w[:-1]).astype(np.float32) + w[-1]

    def back(v: np.ndarray) -> np.ndarray:
        return np.append(scale * (v.astype(np.float32) @ x), v.sum())

    v = np.ones(x.shape[1] + 1)
    for _ in range(20):
        v = back(share * value(v))
        v /= np.linalg.norm(v)
    bound = 1e-3 + 2.2 * float(v @ back(share * value(v)))
    w = last = np.zeros(x.shape[1] + 1)
    for t in range(steps):
        look = w + t / (t + 3) * (w - last)
        slack = np.maximum(1 - y * value(look), 0)
        last, w = w, look - (1e-3 * look - 2 * back(share * y * slack)) / bound
    return scale * w[:-1], float(w[-1])


class Hierarchy:
    """Machines between families, and between the languages of each family."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        """x: trigram frequencies of the fitted texts; langs: their languages."""
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs.tolist())):
            self.families.setdefault(_FAMILY.get(lang, lang), []).append(lang)
        family = np.array([_FAMILY.get(lang, lang) for lang in langs.tolist()])
        scale = 1 / np.sqrt(x.mean(axis=0) + 1e-5) if len(x) else np.zeros(0)
        weights, self.biases, self.pairs = [], [], []
        groups = [(family, sorted(self.families))] + [(langs, members) for members in self.families.values()]
        for of, classes in groups:
            for a, b in combinations(classes, 2):
                w, bias = _svm(x, scale, (of == a) * 1.0 - (of == b))
                self.pairs.append((a, b))
                weights.append(w)
                self.biases.append(bias)
        self.weights = np.array(weights, np.float32).reshape(len(weights), x.shape[1])  # one language needs no machine

    def _votes(self, values: np.ndarray, classes: list[str], first: int) -> np.ndarray:
        """Each class's mean chance over its duels."""
        votes = np.full((values.shape[0], len(classes)), 1.0 if len(classes) == 1 else 0.0)
        for k, (i, j) in enumerate(combinations(range(len(classes)), 2)):
            chance = 1 / (1 + np.exp(-np.clip(3 * values[:, first + k], -30, 30)))
            votes[:, i] += chance / (len(classes) - 1)
            votes[:, j] += (1 - chance) / (len(classes) - 1)
        return votes

    def predict(self, codes: np.ndarray, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        starts = np.concatenate([[0], np.cumsum(counts)])
        values = np.zeros((len(counts), len(self.pairs)))
        some = counts > 0
        for k, (w, bias) in enumerate(zip(self.weights, self.biases)):
            if some.any():
                values[some, k] = np.add.reduceat(w[codes].astype(np.float64), starts[:-1][some]) / counts[some]
            values[:, k] += bias
        names = sorted(self.families)
        first = len(names) * (len(names) - 1) // 2
        votes = self._votes(values, names, 0)
        best = votes.argmax(axis=1)
        langs, score = np.empty(len(counts), object), votes.max(axis=1)
        for f, members in self.families.items():  # as the machines were made
            rows = best == names.index(f)
            inner = self._votes(values[rows], members, first)
            first += len(members) * (len(members) - 1) // 2
            langs[rows] = np.array(members, object)[inner.argmax(axis=1)] if rows.any() else []
            score[rows] *= inner.max(axis=1) if rows.any() else 1
        return langs.tolist(), score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_languages(docs: DataFrame, sample: int = SAMPLE) -> Hierarchy | None:
    """Fit on docs(doc_id, text, lang): of each language, at most sample texts by the smallest hashes of id and text.
    Rows that repeat count once; texts under one id are ranked one by one."""
    known = docs.where("doc_id is not null and text is not null and lang is not null").select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string")).withColumn("h", F.xxhash64("doc_id", "text"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_LANGS else sizes
    # Hashes are even: few more texts than needed are left to be ranked.
    near = known.select("lang", "h").join(sizes, "lang").where((F.col("h") / F.lit(2.0**64) + 0.5) * F.col("n") <= F.lit(2.0 * sample + 50)).select("lang", "h").distinct()
    chosen = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= sample).select("lang", "h")
    rows = known.join(F.broadcast(chosen), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"]).select("doc_id", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for whole in batches:
            for batch in slices(whole):
                codes, counts = trigrams(batch.column("text"))
                parts = [np.unique(c, return_counts=True) for c in np.split(codes, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array([p[0] for p in parts], pa.list_(pa.int32())), pa.array([p[1] for p in parts], pa.list_(pa.int32()))], names=["doc_id", "lang", "codes", "counts"])

    found = rows.mapInArrow(run, "doc_id long, lang string, codes array<int>, counts array<int>").toPandas().sort_values(["doc_id", "lang"])
    if not len(found):
        return None
    x = np.zeros((len(found), 1 << BITS), np.float32)
    for i, (codes, counts) in enumerate(zip(found["codes"], found["counts"])):
        x[i, codes] = np.asarray(counts) / max(sum(counts), 1)
    return Hierarchy(x, found["lang"].to_numpy())


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs(doc_id, text, lang) -> doc_id, held_out, lang_pred, score; a row for each row of docs.

    Learns from text and lang of rows with a lang whose crc32(doc_id as text) mod 4 is not 2; the others are
    held out. lang_pred is und with score 0 if text is null or has no letter, or if nothing could be learned.
    score is the product of the family's and the language's mean chances in their duels; ties go to the smaller name. If
    only one language was learned, it is every text's. Texts of any length are read whole. Repeated rows get equal results
    and are learned from once, rows that share an id are learned from one by one; further columns are ignored; an empty
    table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        model = shared.value
        for whole in batches:
            for batch in slices(whole):
                texts = batch.column("text").fill_null("")
                langs, score = model.predict(*trigrams(texts)) if model else (["und"] * batch.num_rows, np.zeros(batch.num_rows))
                some = _lettered(texts)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([x if s else "und" for x, s in zip(langs, some)], pa.string()), pa.array(np.where(some, np.round(score, 6), 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
