"""Operator 2, best-fit packing: documents become token sequences of bounded length, packed by sum of squares.

The rule keeps, for every residual gap, the number of open bins with that gap, and puts a piece where the sum
of the squared counts becomes smallest. The pieces' sizes alone matter, so they can be dealt out evenly.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonweave.llm._hashing import cache_of, slices
from axonweave.llm._tables import store

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"
#: White space to Python's str.split but not to the tokenizer.
_ODD = re.compile("[\x1c-\x1f]")
_PUNCTUATION = "!-/:-@\\[-`{-~"
#: Latin letters between punctuation: the tokenizer splits just there ("'s" and "<|" start other splits).
_PLAIN = re.compile(f"([!-&(-/:;=-@\\[-`{{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]*)([{_PUNCTUATION}]*)")
_CACHE_WORDS = 800_000
_JOIN = 500
#: Text that is tokenized at once; new words are looked up together.
SLICE_BYTES = 2_000_000
_tokenizers: dict[str, tuple] = {}


def _encoder(name: str):
    """The tokenizer, which of its ids end a word, and a cache of the ids of words.

    Its splitting never joins characters across white space, so a text's ids are its words' ids in a row.
    """
    if name not in _tokenizers:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        ends = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
        ends[[i for w, i in tokenizer.get_vocab().items() if w.endswith("</w>")]] = True
        _tokenizers[name] = (tokenizer, ends, cache_of(name))
    return _tokenizers[name]


def _learn(words: set[str], name: str) -> None:
    """Put the ids of words, as little-endian 32-bit bytes, into the cache."""
    tokenizer, ends, cache = _encoder(name)
    split = {w: m.groups() for w in words if (m := _PLAIN.fullmatch(w))}
    cores = [c for c in {core.lower() for _, core, _ in split.values() if core} if c not in cache]
    for at in range(0, len(cores), _JOIN):  # plain words in one text: an id that ends a word ends its ids
        part = cores[at : at + _JOIN]
        ids = np.array(tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) == len(part):
            data = ids.tobytes()
            cache.update(zip(part, (data[4 * a : 4 * b] for a, b in zip([0, *cuts.tolist()], cuts.tolist()))))
    single = {x for x in (y for before, core, after in split.values() for y in (before, core.lower(), after)) if x and x not in cache}
    single = [*single | (words - split.keys())]
    for w, e in zip(single, tokenizer.encode_batch_fast(single, add_special_tokens=False)):
        cache[w] = np.array(e.ids, "<u4").tobytes()
    cache[""] = b""
    for w, (before, core, after) in split.items():
        cache[w] = cache[before] + cache[core.lower()] + cache[after]


def _encoded(texts: list[str], name: str) -> list[bytes]:
    """Little-endian 32-bit ids of each text."""
    tokenizer, _, cache = _encoder(name)
    if len(cache) > _CACHE_WORDS:
        cache.clear()
    found, missing = [], {}
    for t in texts:
        if _ODD.search(t):
            found.append([np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()])
            continue
        words = t.split()
        found.append(parts := [*map(cache.get, words)])
        if None in parts:
            missing[len(found) - 1] = {i: words[i] for i, x in enumerate(parts) if x is None}
    _learn({w for at in missing.values() for w in at.values()}, name)
    for k, at in missing.items():
        for i, w in at.items():
            found[k][i] = cache[w]
    return [b"".join(parts) for parts in found]


def token_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048, end_id: int = 0) -> DataFrame:
    """Each document's ids with end_id behind them, cut into pieces of at most limit ids; null text is empty.

    Returns doc_id, piece, start, length and ids_crc32 (of the little-endian unsigned 32-bit ids).
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, size=SLICE_BYTES):
                rows = []
                for doc, data in zip(batch.column("doc_id").to_pylist(), _encoded(batch.column("text").fill_null("").to_pylist(), tokenizer)):
                    data += end
                    for k, at in enumerate(range(0, len(data), 4 * limit)):
                        part = data[at : at + 4 * limit]
                        rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                doc, piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each piece, taken in the order given; best from long to short.

    Of the open bins that have room, a piece takes the one after which the sum of the squared counts of bins
    per gap is smallest (ties: the smallest gap); it opens a bin only if none has room.
    """
    count = np.zeros(limit + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(limit + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for i, s in enumerate(lengths.tolist()):
        gap, b = limit, used
        if s < limit:
            # the sum's change for gaps s .. limit - 1; a gap of 0 counts for nothing
            change = 1 - 2 * count[s:limit]
            change[1:] += 2 * count[1 : limit - s] + 1
            change[count[s:limit] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            if count[s + best]:
                gap = s + best
                b = open_bins[gap].pop()
                count[gap] -= 1
        used += b == used
        bins[i], offsets[i] = b, limit - gap
        if gap > s:
            open_bins[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def pack(pieces: DataFrame, limit: int = 2048, group: int = 16_384) -> DataFrame:
    """Put pieces into sequences of at most limit tokens, with sequence_id and a gapless offset.

    Pieces are dealt evenly by a hash of doc_id, piece, ids and the row's number to groups of about group pieces, so rows
    without or with one doc_id are spread too, and equal rows as well. Each group is packed on its own and leaves about one
    sequence part-filled, so what is lost to dealing is about one sequence in group / 3. Which of several equal pieces
    goes to which group follows the order of rows in pieces, which a stored table has for good. No pieces: no rows.
    """
    groups = max(1, -(-pieces.count() // group))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        lengths = table.column("length").to_numpy()
        order = np.lexsort((table.column("ids_crc32").to_numpy(), table.column("piece").to_numpy(), table.column("doc_id").to_numpy(), -lengths))
        bins, offsets = sum_of_squares(lengths[order], limit)
        table = table.take(pa.array(order))
        first = TaskContext.get().partitionId() << 40
        yield from table.append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets)).combine_chunks().to_batches()

    numbered = pieces.withColumn("deal", F.monotonically_increasing_id())
    return numbered.repartition(groups, "doc_id", "piece", "ids_crc32", "start", "deal").drop("deal").mapInArrow(fill, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """Tokenize, cut and pack docs (doc_id, text; other columns are ignored).

    A null doc_id is kept as null; repeated rows are packed as often as they occur. The pieces, without their
    texts, are stored once, so no text is tokenized twice.
    """
    return pack(store(token_pieces(docs, tokenizer, limit)), limit)
