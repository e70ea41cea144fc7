"""Operator 5, n-gram Jaccard join: exact links between texts whose shingle sets overlap enough, as components.

A text's set is held by an id made of its content, so copies are one set from the start. The index has, for
each shingle, the sets that hold it among their rarest shingles, with its position in the set's order. Two
levels of skipping keep the work small (relations between sets, as in the literature on set similarity joins):

* lists are read in blocks of near size and position; a block is skipped if the bound on the overlap of its
  best entry is too small;
* every set is first compared with a list's pivot, the set with the fewest rarer shingles. What it shares with
  the pivot bounds what it shares with any other set of that pivot, so most further answers are derived.

Sets that are already in one component need no comparison, so no group of near copies is expanded into pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonweave.llm._hashing import distinct, drop_caches, hashed_words, joined, mix, slices
from axonweave.llm._tables import store
from axonweave.llm.components import components

#: Counters of the sketch by which shingles are ordered; any order gives the same links.
SKETCH_BITS = 20
SKETCH_PARTS = 16
GROUPS = 64
#: Ids that are sent to every task; beyond, the join is a shuffle.
BROADCAST_IDS = 100_000
BLOCK = 8

PROFILE = "doc_id long, n int, sid long, groups array<int>, part int, counts binary"


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; fewer words than width: the whole sequence as one."""
    words, counts = hashed_words(texts)
    grown = words
    for k in range(1, width):
        grown = joined(grown[: len(words) - k], words[k:])
    found, at = [], 0
    for n in counts.tolist():
        if n >= width:
            found.append(distinct(grown[at : at + n - width + 1]))
        elif n:
            one = mix(words[at : at + 1] + np.uint64(n))
            for k in range(1, n):
                one = joined(one, words[at + k : at + k + 1])
            found.append(one)
        else:
            found.append(words[:0])
        at += n
    return found


def _set_id(hashes: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True) if len(hashes) else None


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (id and size of its set, its shingles per hash group), and the parts of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for whole in batches:
            for batch in slices(whole):
                sets = shingle_sets(batch.column("text"), width)
                if not sets:
                    continue
                flat = np.concatenate(sets)
                sketch += np.bincount(flat >> np.uint64(64 - SKETCH_BITS), minlength=len(sketch)).astype(np.uint32)
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                groups = np.bincount(owner * GROUPS + (flat % np.uint64(GROUPS)).astype(np.int64), minlength=len(sets) * GROUPS).astype(np.int32)
                none = pa.nulls(len(sets), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()), pa.array(map(_set_id, sets), pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(0, len(groups) + 1, GROUPS, dtype=np.int32)), pa.array(groups)), none, pa.nulls(len(sets), pa.binary())],
                    names=["doc_id", "n", "sid", "groups", "part", "counts"],
                )
        parts = [p.tobytes() for p in np.split(sketch, SKETCH_PARTS)]
        k = len(parts)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int32())), pa.array(range(k), pa.int32()), pa.array(parts, pa.binary())], names=["doc_id", "n", "sid", "groups", "part", "counts"])

    return docs.mapInArrow(run, PROFILE)


def _sketch(profiles: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches: added up within tasks first, then by part; fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for part, data in zip(b.column("part").to_pylist(), b.column("counts")):
                x = np.frombuffer(data.as_buffer(), np.uint32)
                total[part] = total[part] + x if part in total else x.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "counts"])

    rows = profiles.where("part is not null").select("part", "counts").mapInArrow(add, "part int, counts binary").repartition(SKETCH_PARTS, "part").mapInArrow(add, "part int, counts binary").collect()
    parts = [np.frombuffer(r.counts, np.uint32) for r in sorted(rows, key=lambda r: r.part)]
    return np.concatenate(parts) if parts else np.zeros(1 << SKETCH_BITS, np.uint32)  # a table without partitions


def _entries(docs: DataFrame, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """Index entries: a set's rarest shingles, as many as must hold one of any linked set's, with positions."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        count = shared.value
        for whole in batches:
            for batch in slices(whole):
                tokens, ids, sizes, places = [], [], [], []
                for s in {_set_id(s): s for s in shingle_sets(batch.column("text"), width)}.values():
                    if n := len(s):
                        k = n - (percent * n + 99) // 100 + 1
                        tokens.append(s[np.lexsort((s, count[s >> np.uint64(64 - SKETCH_BITS)]))[:k]])
                        ids.append((_set_id(s), k))
                        sizes.append(n)
                        places.append(np.arange(k, dtype=np.int32))
                if tokens:
                    k = [x[1] for x in ids]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array([x[0] for x in ids], np.int64), k)), pa.array(np.repeat(np.array(sizes, np.int32), k)), pa.array(np.concatenate(places))], names=["token", "sid", "n", "pos"])

    return docs.select("text").mapInArrow(run, "token long, sid long, n int, pos int")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for whole in batches:
            for batch in slices(whole):
                sets = shingle_sets(batch.column("text"), width)
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(map(_set_id, sets), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["sid", "hashes"])

    return docs.select("text").mapInArrow(run, "sid long, hashes array<long>")


def _needed(n: Column, m: Column, percent: int) -> Column:
    """The least overlap of linked sets of sizes n and m: percent * (n + m - o) <= 100 * o."""
    return F.ceil(percent * (n + m) / F.lit(100 + percent))


def _possible(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Whether sets whose first shared shingle stands at i and j can be linked; also bounds their sizes."""
    return F.least(n - i, m - j) >= _needed(n, m, percent)


def _band(n: Column, percent: int) -> Column:
    """Linked sets are in equal or neighbouring bands of sizes; bands are a little wider than that needs."""
    return F.floor(F.log(n) / float(-np.log((percent - 1) / 100.0)))


def _bounded(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets share enough by hash group: the sum of the smaller counts bounds the overlap."""
    a = groups.select(F.col("sid").alias("a"), F.col("groups").alias("ga"))
    b = groups.select(F.col("sid").alias("b"), F.col("groups").alias("gb"))
    most = F.aggregate(F.zip_with("ga", "gb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    return pairs.join(a, "a").join(b, "b").where(most >= _needed(F.col("na"), F.col("nb"), percent)).drop("ga", "gb")


def _verified(pairs: DataFrame, groups: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """pairs(a, b, na, nb) with the exact overlap of their sets."""
    used = store(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct().join(groups.select("sid", "rep"), "sid").select(F.col("rep").alias("doc_id"), "sid"))
    ids = used.select("doc_id").distinct()
    ids = F.broadcast(ids) if used.count() <= BROADCAST_IDS else ids
    sets = _sets(docs.join(ids, "doc_id", "left_semi"), width)
    sets = store(sets.join(used.select("sid"), "sid", "left_semi").dropDuplicates(["sid"]))
    a, b = sets.select(F.col("sid").alias("a"), F.col("hashes").alias("ha")), sets.select(F.col("sid").alias("b"), F.col("hashes").alias("hb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("ha", "hb")).alias("shared"))


def _derived(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """For each pair, the bounds on its overlap that a common pivot's known overlaps give."""
    both = known.select(F.col("a").alias("x"), F.col("b").alias("p"), F.col("nb").alias("np"), "shared").union(known.select("b", "a", "na", "shared"))
    one = both.select(F.col("x").alias("a"), "p", "np", F.col("shared").alias("sa"))
    two = both.select(F.col("x").alias("b"), "p", F.col("shared").alias("sb"))
    met = pairs.join(one, "a").join(two, ["b", "p"])
    low = F.col("sa") + F.col("sb") - F.col("np")
    high = F.least(F.col("sa") + F.col("nb") - F.col("sb"), F.col("sb") + F.col("na") - F.col("sa"))
    bounds = met.groupBy("a", "b").agg(F.max(low).alias("low"), F.min(high).alias("high"))
    return pairs.join(bounds, ["a", "b"], "left").select("a", "b", "na", "nb", F.coalesce("low", F.lit(0)).alias("low"), F.coalesce("high", F.least("na", "nb")).alias("high"), _needed(F.col("na"), F.col("nb"), percent).alias("least"))


def _by_document(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between the smallest documents of the sets: the smallest node of a component is then its id."""
    rep = lambda c: groups.select(F.col("sid").alias(c), F.col("rep").alias(f"{c}_rep"))
    return links.join(rep("a"), "a").join(rep("b"), "b").select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).where("a <> b").distinct()


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id, set_id; a row for each row of docs.

    Words are runs of characters other than space and \\t to \\r, A-Z lower-cased. Texts link when
    100 * overlap >= percent * union of their distinct width-word shingles. A null or empty text, or one without
    words, has an empty set and links with nothing. component_id is the smallest doc_id that links reach.
    Nodes are texts: rows that share a doc_id but not a text are not linked by the id, and each row has the component of its own
    text. Shingles are compared by 64-bit hashes. A row without doc_id cannot stand for its set: unless another row
    has the same set, it links with nothing. Other columns of docs are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    profiles = store(_profiles(docs, width))
    sketch = _sketch(profiles)
    rows = profiles.where("n is not null").select("doc_id", "n", "sid", "groups")
    entries = store(_entries(docs, width, percent, sketch))
    several = entries.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo <> hi").select("token")
    index = store(entries.join(several, "token").distinct())
    groups = rows.where("doc_id is not null and sid is not null").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("groups").alias("groups"))
    groups = store(groups.join(index.select("sid").distinct(), "sid", "left_semi"))

    # Each set against the pivots of its lists.
    pivots = index.groupBy("token").agg(F.min(F.struct("pos", "n", "sid")).alias("p"))
    star = index.join(pivots, "token").where((F.col("sid") != F.col("p.sid")) & _possible(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos"), percent))
    first = F.col("sid") < F.col("p.sid")
    star = star.select(F.least("sid", "p.sid").alias("a"), F.greatest("sid", "p.sid").alias("b"), F.when(first, F.col("n")).otherwise(F.col("p.n")).alias("na"), F.when(first, F.col("p.n")).otherwise(F.col("n")).alias("nb")).distinct()
    star = store(star)
    known = store(_verified(store(_bounded(star, groups, percent)), groups, docs, width, percent))
    links = known.where(F.col("shared") >= _needed(F.col("na"), F.col("nb"), percent)).select("a", "b")
    labels = components(_by_document(links, groups))

    # What is left: entries outside their list's largest component, against the blocks of the list.
    placed = index.join(groups.select("sid", "rep"), "sid").join(labels, F.col("rep") == F.col("node"), "left").withColumn("label", F.coalesce("label", "rep")).drop("rep", "node")
    placed = store(placed.withColumns({"band": _band(F.col("n"), percent), "block": F.floor(F.col("pos") / BLOCK)}))
    parts = placed.groupBy("token", "label").agg(F.count("*").alias("k"))
    mixed = parts.groupBy("token").agg(F.max(F.struct("k", "label")).alias("m"), F.count("*").alias("labels")).where("labels > 1").select("token", F.col("m.label").alias("main"))
    rest = placed.join(mixed, "token").where("label <> main").drop("block")
    blocks = placed.groupBy("token", "band", "block").agg(F.min("pos").alias("least_pos"), F.max("n").alias("most_n"), F.min("n").alias("least_n"))
    near = rest.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    # A block's best entry: its smallest position, and a size that asks for the least or leaves the most.
    open_ = near.join(blocks, ["token", "band"]).where(F.least(F.col("n") - F.col("pos"), F.col("most_n") - F.col("least_pos")) >= _needed(F.col("n"), F.col("least_n"), percent)).drop("least_pos", "most_n", "least_n")
    other = placed.select("token", "band", "block", F.col("sid").alias("sid2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("label").alias("label2"))
    pairs = open_.join(other, ["token", "band", "block"]).where((F.col("label") != F.col("label2")) & ((F.col("label2") == F.col("main")) | (F.col("sid") < F.col("sid2"))) & _possible(F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2"), percent))
    first = F.col("sid") < F.col("sid2")
    pairs = pairs.select(F.least("sid", "sid2").alias("a"), F.greatest("sid", "sid2").alias("b"), F.when(first, F.col("n")).otherwise(F.col("n2")).alias("na"), F.when(first, F.col("n2")).otherwise(F.col("n")).alias("nb")).distinct()
    pairs = pairs.join(star.select("a", "b"), ["a", "b"], "left_anti")
    answers = store(_derived(store(_bounded(store(pairs), groups, percent)), known, percent))
    open_pairs = store(answers.where("low < least and high >= least").select("a", "b", "na", "nb"))
    more = answers.where("low >= least").select("a", "b")
    if not open_pairs.isEmpty():
        late = _verified(open_pairs, groups, docs, width, percent)
        more = more.union(late.where(F.col("shared") >= _needed(F.col("na"), F.col("nb"), percent)).select("a", "b"))
    more = store(more)
    if not more.isEmpty():
        labels = components(_by_document(links.union(more), groups))

    # A set's component: the smallest document of any set with its label.
    sets = rows.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first"))
    found = store(sets.join(groups.select("sid", "rep"), "sid", "left").join(labels, F.col("rep") == F.col("node"), "left").select("sid", F.coalesce("label", "first").alias("component")))
    return rows.select("doc_id", "n", "sid").join(found, "sid", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.col("sid").alias("set_id"))
