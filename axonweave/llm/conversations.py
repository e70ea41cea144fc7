"""Operator 12, repair of conversations by weighted interval parsing.

Legal role initials are (s?(ua)+)?. With the states of its automaton - start, s read, u read, a read - the grammar in
Chomsky normal form has a symbol X_ij for "goes from state i to state j", the rules X_ij -> X_ik X_kj, and terminal rules
for what may become of one row: kept, reroled or deleted. Symbols are closed under insertion. A cell holds, for a span of
rows and a symbol, the least cost and, of the edits with that cost, the least audit. Cells of longer spans are made from those
of shorter ones, bottom-up by span length.

Every way to part a span gives the same cells here, as the state between two rows is some k whatever stands around it. So
one split of a span is enough, n rows need n - 1 products, and a long conversation is parsed in blocks of rows by many
tasks whose cells are put together afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from axonweave.llm._tables import store

# Costs of edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an initial leads from a state.
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (START, ASSISTANT)
#: Rows of a block, of one stored file each, and cells put together in a task, both as powers of two.
BLOCK_BITS, MERGE_BITS = 12, 6
#: Spans of so many rows at most are remembered by their rows' classes.
REMEMBERED = 16

Cell = tuple[int, str] | None
Cells = tuple[tuple[Cell, ...], ...]


def product(x: Cells, y: Cells) -> Cells:
    """X_ij -> X_ik X_kj. Audits of one cost and span are never prefixes of one another, so the least of a whole is
    made of the least of its parts."""
    def best(i: int, j: int) -> Cell:
        found = None
        for k in range(4):
            a, b = x[i][k], y[k][j]
            if a is not None and b is not None and (found is None or (a[0] + b[0], a[1] + b[1]) < found):
                found = (a[0] + b[0], a[1] + b[1])
        return found

    return tuple(tuple(best(i, j) for j in range(4)) for i in range(4))


def _closure() -> Cells:
    """What insertions alone can do: X_ii is empty, and longer chains are tried until nothing gets cheaper."""
    cells = tuple(tuple((0, "") if i == j else (INSERT, "I") if any(STEPS.get((i, r)) == j for r in "ua") else None for j in range(4)) for i in range(4))
    while True:
        longer = product(cells, cells)
        if longer == cells:
            return cells
        cells = longer


INSERTIONS = _closure()


@lru_cache(maxsize=None)
def leaf(initial: str, fault: str) -> Cells:
    """The cells of one row, insertions before and after it included. initial: s, u, a, or else; fault: blank or
    duplicate (d), truncated (t), or none."""
    cells: list[list[Cell]] = [[(DELETE, "D") if i == j else None for j in range(4)] for i in range(4)]
    if fault != "d":
        more = TRUNCATED * (fault == "t")
        for (i, r), j in STEPS.items():
            ways = [(KEEP + more, "K")] * (r == initial) + [(REROLE + more, "R")] * (r in "ua")
            if ways:
                cells[i][j] = min(ways)
    row = tuple(map(tuple, cells))
    return product(product(INSERTIONS, row), INSERTIONS)


def _parse(rows: list[Cells]) -> Cells:
    """Cells of spans of one, two, four ... rows, bottom-up."""
    while len(rows) > 1:
        rows = [product(rows[i], rows[i + 1]) if i + 1 < len(rows) else rows[i] for i in range(0, len(rows), 2)]
    return rows[0] if rows else INSERTIONS


@lru_cache(maxsize=100_000)
def _remembered(classes: str) -> Cells:
    return _parse([leaf(classes[i], classes[i + 1]) for i in range(0, len(classes), 2)])


def parse(classes: str) -> Cells:
    """classes: two letters a row, its initial (s, u, a or -) and its fault (d, t or -)."""
    size = 2 * REMEMBERED
    return _parse([_remembered(classes[i : i + size]) for i in range(0, len(classes), size)])


def outcome(cells: Cells) -> tuple[int, str]:
    return min(c for c in (cells[START][j] for j in FINAL) if c is not None)


def repaired(rows: Iterable[tuple[str, str]], audit: str) -> Iterator[str]:
    """Lines `role:text` of rows (role, text) after the edits in audit."""
    rows, role = iter(rows), None

    def due() -> str:
        return "assistant" if role == "u" else "user"

    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        name, text = (due(), "") if edit == "I" else next(rows)
        name = due() if edit == "R" else name
        role = name[0]
        yield f"{name}:{text}"


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with one fault in every fourth row, by crc32(`conv_id:turn`) % 20; null roles, texts and parts of the
    key are one space."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("_d", F.pmod(F.crc32(key.cast("binary")), F.lit(20))).where("_d <> 0")
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("_d") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def placed(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text) stored in order, with pos growing in it and digest, the text's md5. By turn, null
    first; ties by role, then by digest. A conversation may lie in many files, and rows that are alike in all may too."""
    order = ["conv_id", "turn", "role", "digest", "_id"]
    keyed = rows.withColumns({"digest": F.md5(F.col("text").cast("binary")), "_id": F.monotonically_increasing_id()})
    return store(keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_id").withColumn("pos", F.monotonically_increasing_id()))


def faulted(rows: DataFrame) -> DataFrame:
    """placed rows -> conv_id, pos, turn, initial, fault: blank, duplicate, truncated, or empty; the first that holds."""
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first"))
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    slim = rows.select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), (last == "").alias("_blank"), (~last.isin(".", "!", "?")).alias("_cut"))
    fault = F.when(F.col("_blank"), "blank").when(F.col("_first").isNull(), "duplicate").when(F.col("_cut"), "truncated").otherwise("")
    return slim.join(firsts, "pos", "left").select("conv_id", "pos", "turn", "initial", fault.alias("fault"))


_CELL = "array<struct<cost: bigint, audit: string>>"
#: A part of a conversation: its rows' counts, what stands at its ends, and its cells.
PART = f"conv_id long, pos long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string, cells {_CELL}"
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
LEGAL = ("su", "ua", "au")


def _joined(a: dict, b: dict) -> dict:
    """Two parts side by side."""
    out = {k: a[k] + b[k] for k in _COUNTS}
    out["illegal"] += a["tail"] + b["head"] not in LEGAL
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]  # turns are in order
    out |= {"conv_id": a["conv_id"], "pos": a["pos"], "head": a["head"], "tail": b["tail"], "low": a["low"] if a["low"] is not None else b["low"], "high": b["high"] if b["high"] is not None else a["high"]}
    return out


def _batches(rows: list[dict], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist(rows[at : at + size], schema=schema)


_ARROW_PART = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), *((k, pa.int64()) for k in _COUNTS), ("low", pa.int64()), ("high", pa.int64()), ("head", pa.string()), ("tail", pa.string()), ("cells", pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())])))])


def _runs(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that follow one another with equal names, a list at a time."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[n] for n in names)
            if held and now != key:
                yield key, held
                held = []
            key = now
            held.append(row)
    if held:
        yield key, held


def _of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order -> the parts that a block has of its conversations. A part at an end of its block may go on in another
    one and has all cells; others are complete and have the whole parse's alone."""
    made: list[dict] = []
    for _, rows in _blocks(batches):
        turns = [r["turn"] for r in rows if r["turn"] is not None]
        initials = [r["initial"] for r in rows]
        faults = [r["fault"] for r in rows]
        cells = parse("".join((i if i in ("s", "u", "a") else "-") + {"": "-", "truncated": "t"}.get(f, "d") for i, f in zip(initials, faults)))
        made.append({"conv_id": rows[0]["conv_id"], "pos": rows[0]["pos"], "head": initials[0], "tail": initials[-1], "cells": _listed(cells),
                     "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "turns": len(set(turns)), "low": turns[0] if turns else None, "high": turns[-1] if turns else None} | {k: faults.count(k) for k in _COUNTS[:3]})
        if len(made) >= 500:
            yield from _batches(made, _ARROW_PART)
            made = []
    yield from _batches(made, _ARROW_PART)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    return _runs(batches, "block", "conv_id")


def _listed(cells: Cells) -> list:
    return [None if c is None else {"cost": c[0], "audit": c[1]} for row in cells for c in row]


def _square(cells: list) -> Cells:
    flat = [None if c is None else (c["cost"], c["audit"]) for c in cells]
    return tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4))


def _of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: list[dict] = []
    for _, parts in _runs(batches, "block", "conv_id"):
        whole = parts[0]
        for part in parts[1:]:
            whole = _joined(whole, part)
        whole["cells"] = _listed(_parse([_square(p["cells"]) for p in parts]))
        whole.pop("block", None)
        made.append(whole)
        if len(made) >= 500:
            yield from _batches(made, _ARROW_PART)
            made = []
    yield from _batches(made, _ARROW_PART)


def _in_blocks(rows: DataFrame, bits: int) -> DataFrame:
    """rows by blocks of pos, in order. A block of another conversation in between is no harm: keys are both."""
    return rows.withColumn("block", F.shiftright("pos", bits)).repartition("block").sortWithinPartitions("block", "pos")


def parsed(rows: DataFrame, block_bits: int = BLOCK_BITS, merge_bits: int = MERGE_BITS) -> DataFrame:
    """faulted rows -> one part (PART) for each conversation. Blocks are parsed apart; parts of a conversation are put
    together 2**merge_bits at a time, over so many rounds as its length needs."""
    parts = store(_in_blocks(rows, block_bits).mapInArrow(_of_rows, PART))
    while True:
        # null-safe: rows without a conversation's id are one conversation
        several = store(parts.groupBy("conv_id").agg(F.count("*").alias("c")).where("c > 1").select(F.col("conv_id").alias("_id")))
        if several.isEmpty():
            return parts
        split = parts.join(several, parts.conv_id.eqNullSafe(F.col("_id")), "left_semi")
        rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("pos")) - 1  # a row for each part, without its cells
        group = split.select("conv_id", "pos").select("pos", F.shiftright(rank, merge_bits).alias("block"))
        merged = split.join(group, "pos").repartition("conv_id", "block").sortWithinPartitions("conv_id", "pos").mapInArrow(_of_parts, PART)
        parts = store(parts.join(several, parts.conv_id.eqNullSafe(F.col("_id")), "left_anti").unionByName(merged))


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ARROW_RESULT = pa.schema([("conv_id", pa.int64()), *((k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation its findings and then its rows in order -> the findings with the hash of the repaired
    conversation. Rows are hashed as they come and not held."""
    stream = (row for batch in batches for row in batch.to_pylist())
    made: list[dict] = []
    row = next(stream, None)
    while row is not None:
        found = row["found"]
        texts = _Following(stream)
        digest, first = hashlib.sha256(), True
        for line in repaired(texts, found["audit"]):
            digest.update(("" if first else "\n").encode() + line.encode())
            first = False
        row = texts.rest()
        made.append({"conv_id": found["conv_id"], "repaired_sha256": digest.hexdigest()} | {k: found[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")})
        if len(made) >= 500:
            yield from _batches(made, _ARROW_RESULT)
            made = []
    yield from _batches(made, _ARROW_RESULT)


class _Following:
    """The rows up to the next finding, which stays for the caller."""

    def __init__(self, stream: Iterator[dict]):
        self.stream, self.ahead = stream, None

    def __iter__(self) -> Iterator[tuple[str, str]]:
        for row in self.stream:
            if row["found"] is not None:
                self.ahead = row
                return
            yield row["role"], row["text"]

    def rest(self) -> dict | None:
        return self.ahead if self.ahead is not None else next((r for r in self.stream if r["found"] is not None), None)


def findings(parts: DataFrame) -> DataFrame:
    """conv_id and what is found of it: gaps, faults, illegal neighbours, cost and audit of the cheapest repair."""
    ends = F.array_compact(F.array(*(F.get("cells", F.lit(4 * START + j)) for j in FINAL)))
    best = F.array_min(ends)
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    return parts.select("conv_id", F.struct("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", best["cost"].alias("cost"), best["audit"].alias("audit")).alias("found"))


def repair(conversations: DataFrame, block_bits: int = BLOCK_BITS, merge_bits: int = MERGE_BITS) -> DataFrame:
    """conversations(conv_id, turn, role, text), damaged already -> per conv_id: gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256.

    Null roles and texts are one space, rows with a null conv_id are one conversation, null turns stand first and count
    for no gap. Rows with one turn stand by role, then by the md5 of their text; repeated rows are duplicates. Roles count by
    their first letter; an empty role has none and is never kept. Texts of any length are read whole; further columns are
    ignored; an empty table gives no rows. A conversation is parsed by many tasks and hashed by one, as SHA-256 is
    sequential: that task streams its rows.
    """
    space = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))
    rows = placed(rows)
    found = findings(parsed(faulted(rows), block_bits, merge_bits))
    every = found.withColumn("pos", F.lit(-1).cast("long")).unionByName(rows.select("conv_id", "pos", "role", "text"), allowMissingColumns=True)
    return every.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_finish, RESULT)


def structure_repair(conversations: DataFrame, **options) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> repair of what `damaged` makes of them, for every conv_id; one that lost
    all rows has zeros, an empty audit and the hash of nothing. Cases as in `repair`."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    done = repair(damaged(rows), **options)
    ids = rows.select("conv_id").distinct().withColumnRenamed("conv_id", "_id")
    out = ids.join(done, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


__all__ = ["damaged", "outcome", "parse", "repair", "repaired", "structure_repair"]
