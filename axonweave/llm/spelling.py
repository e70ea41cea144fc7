"""Operator 13, groups of spelling variants by dynamic programming over sorted lists.

Words are near if one inserted, deleted or replaced code point parts them. Of two such words one half stays as it is, so
words meet in groups that share the first or the last half. Within a group the sorted rests of the words are walked
once for all queries together: ranges of words with a common prefix share the rows of the edit matrix, of which a band of
three is kept; adjacent words' common prefixes say where a range parts; a range is left as soon as its common prefix is
more than one edit away from the query.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonweave.llm._tables import store

#: Words have so many code points, and occur so often, at least; one run of EVERY loses a code point.
SHORTEST, LEAST, EVERY = 5, 3, 97
#: A group of more words is parted by longer shared halves, until what is not shared is a single code point.
GROUP = 50_000
#: Words of complete groups that are walked together, and queries of them at a time.
WALKED, QUERIES = 20_000, 8_192
#: So few pairs are compared as they are instead of level by level.
FEW = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """docs(doc_id, text) -> word, n: what runs of letters of whole texts become, if long and frequent enough.

    A run is lower-cased (A-Z only) and loses a code point if every divides the crc32 of `doc_id:run`; a null doc_id
    is empty there. Counts are combined before the shuffle.
    """
    low = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(low, F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    word = F.when(F.pmod("h", F.lit(every)) == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _halved(rows: DataFrame) -> DataFrame:
    """rows(word, n, m, a, b, below, path): words that share their first a and last b code points, of length m or m + 1.
    Two of them that are near, the shorter of length m, share half of what is left too, at its start (P) or its end (S).
    Pairs with a common prefix of below or more are another group's."""
    half = F.expr("(m - a - b) div 2").cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("below").alias("below"), F.concat("path", F.lit("P")).alias("path"))
    last = F.struct(F.col("a").alias("a"), (F.col("b") + half).alias("b"), F.least("below", F.col("a") + half).alias("below"), F.concat("path", F.lit("S")).alias("path"))
    return rows.select("word", "n", "m", F.inline(F.array(first, last)))


def _key() -> Column:
    return F.concat_ws("/", "m", "path", F.substr("word", F.lit(1), F.col("a")), F.when(F.col("b") > 0, F.expr("right(word, b)")).otherwise(""))


def grouped(words: DataFrame, group: int = GROUP, shortest: int = SHORTEST) -> DataFrame:
    """words(word, n) -> key, rest, word, n, short, below: the groups in which near words meet, each pair in one of them.
    rest is what a group does not share, short the length that the rest of the shorter word has. Groups of more than
    group words are halved again as long as that is possible."""
    none = F.lit(2**31 - 1)
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where(F.col("m") >= shortest)
    rows = _halved(rows.select("*", F.lit(0).alias("a"), F.lit(0).alias("b"), none.alias("below"), F.lit("").alias("path"))).withColumn("key", _key())
    parts = []
    while True:
        hot = store(rows.where("m - a - b >= 2").groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > group).select("key"))
        if hot.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(hot, "key", "left_anti"))
        rows = store(_halved(rows.join(hot, "key", "left_semi").drop("key")).withColumn("key", _key()))
    rest = F.substr("word", F.col("a") + 1, F.length("word") - F.col("a") - F.col("b"))
    every = reduce(DataFrame.unionByName, parts)
    return every.select("key", rest.alias("rest"), "word", "n", F.expr("m - a - b").cast("int").alias("short"), (F.col("below") - F.col("a")).alias("below"))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, with zeros after them, and each text's start and length."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return np.append(codes, np.zeros(2, np.uint32)), np.cumsum(sizes) - sizes, sizes


def _common(codes: np.ndarray, start: np.ndarray, sizes: np.ndarray, heads: np.ndarray, texts: list[str]) -> np.ndarray:
    """The length of the prefix that each text shares with the one before it; -1 at the head of a group."""
    shared = np.full(len(texts), -1)
    at, d = np.flatnonzero(~heads), 0
    shared[at] = 0
    while len(at) > FEW:
        at = at[(sizes[at] > d) & (sizes[at - 1] > d)]
        at = at[codes[start[at] + d] == codes[start[at - 1] + d]]
        d += 1
        shared[at] = d
    for i in at.tolist():
        shared[i] = len(os.path.commonprefix([texts[i - 1], texts[i]]))
    return shared


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = len(os.path.commonprefix([a, b]))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p + 1 :] == b[p:] if len(a) > len(b) else a[p:] == b[p + 1 :]


def walk(texts: list[str], heads: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """texts: sorted and distinct within groups, which begin at heads. For each query (a place in texts) the places of
    its group's texts that are one edit away: query, place, and the length of the prefix that both share.

    Level d has the ranges of texts with a common prefix of d code points that are within one edit of some prefix of
    the query. left, mid and right are the row of the edit matrix for it: the distances to the query's first d - 1, d and
    d + 1 code points, 2 standing for all that is more than 1.
    """
    codes, start, sizes = _codes(texts)
    shared = _common(codes, start, sizes, heads, texts)
    by_depth = np.argsort(shared, kind="stable")
    depths = shared[by_depth]
    groups = np.flatnonzero(heads)
    of = np.cumsum(heads) - 1
    ends = np.append(groups[1:], len(texts))
    q = queries
    lo, hi = groups[of[q]], ends[of[q]]
    left, mid, right = np.full(len(q), 2, np.uint8), np.zeros(len(q), np.uint8), np.where(sizes[q] > 0, 1, 2).astype(np.uint8)
    same = np.zeros(len(q), np.int64)
    found, d, last = [], 0, len(codes) - 1
    while len(q):
        if (hi - lo).sum() <= FEW:
            rest = [(i, j) for i, a, b in zip(q.tolist(), lo.tolist(), hi.tolist()) for j in range(a, b) if one_edit(texts[i], texts[j])]
            found.append((np.array([x[0] for x in rest], np.int64), np.array([x[1] for x in rest], np.int64), np.array([len(os.path.commonprefix([texts[i], texts[j]])) for i, j in rest], np.int64)))
            break
        # ranges part where neighbours share d code points
        cuts = np.append(by_depth[np.searchsorted(depths, d, "left") : np.searchsorted(depths, d, "right")], 0)
        i0, i1 = np.searchsorted(cuts[:-1], lo, "right"), np.searchsorted(cuts[:-1], hi, "left")
        counts = i1 - i0 + 1
        up = np.repeat(np.arange(len(q)), counts)
        k = np.arange(len(up)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = np.where(k == 0, lo[up], cuts[np.minimum(i0[up] + k - 1, len(cuts) - 1)])
        end = np.where(k == counts[up] - 1, hi[up], cuts[np.minimum(i0[up] + k, len(cuts) - 1)])
        q, left, mid, right, same = q[up], left[up], mid[up], right[up], same[up]
        size = sizes[q]
        over = sizes[begin] == d  # a text ends here, and stands first in its range
        gap = size - d
        distance = np.where(gap == 0, mid, np.where(gap == 1, right, np.where(gap == -1, left, 2)))
        hit = over & (distance == 1)
        found.append((q[hit], begin[hit], np.where(mid[hit] == 0, np.minimum(d, size[hit]), same[hit])))
        go = ~over & (gap >= -1)
        q, left, mid, right, same, lo, hi, size = q[go], left[go], mid[go], right[go], same[go], begin[go], end[go], size[go]
        c, at = codes[start[lo] + d], start[q] + d
        other = lambda shift: c != codes[np.clip(at + shift, 0, last)]  # noqa: B023, E731
        new_left = np.where(d <= size, np.minimum(left + other(-1), mid + 1), 2)
        new_mid = np.where(d + 1 <= size, np.minimum(np.minimum(mid + other(0), right + 1), new_left + 1), 2)
        new_right = np.where(d + 2 <= size, np.minimum(right + other(1), new_mid + 1), 2)
        same = np.where((mid == 0) & (new_mid > 0), d, same)
        keep = np.minimum(np.minimum(new_left, new_mid), new_right) <= 1
        q, lo, hi, same = q[keep], lo[keep], hi[keep], same[keep]
        left, mid, right = (np.minimum(x[keep], 2).astype(np.uint8) for x in (new_left, new_mid, new_right))
        d += 1
    return tuple(np.concatenate([f[i] for f in found]).astype(np.int64) if found else np.zeros(0, np.int64) for i in range(3))


PARTIAL = "word string, n_near long, form_n long, form string"


def _nearest(rows: pa.Table) -> pa.RecordBatch:
    """Complete groups -> of each word with near words in one of them: how many, and the most frequent."""
    keys, words, rests = (rows.column(c).to_pylist() for c in ("key", "word", "rest"))
    n, short, below = (rows.column(c).to_numpy() for c in ("n", "short", "below"))
    heads = np.fromiter((i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))), bool, len(keys))
    sizes = np.fromiter(map(len, rests), np.int64, len(rests))
    asking = np.flatnonzero(sizes == short)
    x, y = [], []
    for at in range(0, len(asking), QUERIES):
        q, w, same = walk(rests, heads, asking[at : at + QUERIES])
        own = same < below[q]
        q, w = q[own], w[own]
        longer = sizes[w] > sizes[q]  # texts of the shorter length ask, the longer ones are told
        x += [q, w[longer]]
        y += [w, q[longer]]
    x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (x, y))
    rank = np.empty(len(words), np.int64)
    rank[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
    order = np.lexsort((rank[y], -n[y], x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(x)))
    return pa.RecordBatch.from_arrays([pa.array([words[i] for i in x[first]], pa.string()), pa.array(counts, pa.int64()), pa.array(n[y[first]], pa.int64()), pa.array([words[i] for i in y[first]], pa.string())], names=["word", "n_near", "form_n", "form"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        last = batch.column("key")[batch.num_rows - 1].as_py()
        if count >= WALKED and last != held[0].column("key")[0].as_py():
            rows = pa.Table.from_batches(held)
            keys = rows.column("key").to_pylist()
            cut = len(keys)
            while keys[cut - 1] == last:
                cut -= 1
            yield _nearest(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
            count = len(keys) - cut
    if held:
        yield _nearest(pa.Table.from_batches(held))


def near_words(words: DataFrame, group: int = GROUP, shortest: int = SHORTEST) -> DataFrame:
    """words(word, n), distinct -> word, n_near, form_n, form for words that have near ones: how many, and the most
    frequent of them, ties to the smaller in code-point order."""
    rows = grouped(words, group, shortest).repartition("key").sortWithinPartitions("key", "rest")
    parts = rows.mapInArrow(_scan, PARTIAL)
    best = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("a"), F.col("form").alias("form"))).alias("m"))
    return best.select("word", "n_near", (-F.col("m.a")).alias("form_n"), "m.form")


def roots(links: DataFrame) -> DataFrame:
    """links(word, form), without cycles -> word, root: the end of the chain of forms. Each round doubles the steps."""
    at = store(links.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = store(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def spelling_variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY, group: int = GROUP) -> DataFrame:
    """docs(doc_id, text) -> word, form, root, n, n_near, form_n; a row for each word of the vocabulary.

    A word's form is the most frequent word near to it, ties to the smaller in code-point order, if it is at least twice
    as frequent; else form and form_n are null. root is the end of the chain of forms, the word itself if it has none.
    Null and empty texts hold no words, texts are read whole, a null doc_id counts as empty, repeated rows count as
    often as they occur, further columns are ignored, and an empty table gives no rows.
    """
    words = store(vocabulary(docs, shortest, least, every))
    told = words.join(near_words(words, group, shortest), "word", "left")
    twice = F.coalesce(F.col("form_n") >= 2 * F.col("n"), F.lit(False))
    told = store(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(twice, F.col("form")).alias("form"), F.when(twice, F.col("form_n")).alias("form_n")))
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
