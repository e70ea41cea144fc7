"""Vectorised 64-bit hashes of the words of a batch of texts.

A word's hash is a polynomial in its bytes modulo 2**64 (random byte codes, odd base) and a final mix, so
every step is a numpy pass over the batch's UTF-8 buffer; no per-word Python object is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_powers = np.ones(1, np.uint64)

#: Bytes that part words: space and tab to carriage return.
WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
SLICE_BYTES = 1_000_000

#: Caches of this worker process by name. Workers serve one operator after another, so operators that do not use
#: the caches empty them.
_caches: dict[str, dict] = {}


def cache_of(name: str) -> dict:
    return _caches.setdefault(name, {})


def drop_caches() -> None:
    for cache in _caches.values():
        cache.clear()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.ones(max(n, 1024), np.uint64)
        np.multiply.accumulate(np.full(len(_powers) - 1, _BASE), out=_powers[1:])
    return _powers


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and len(texts) + 1 offsets; null is empty."""
    texts = (texts if pa.types.is_large_string(texts.type) else texts.cast(pa.large_string())).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about size bytes of text each."""
    offsets = utf8(batch.column(column))[1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def hashed_words(texts: pa.Array, parts: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, in order; and the number of words of each text."""
    (hashes,), counts = hashed_prefixes(texts, parts, ())
    return hashes, counts


def hashed_prefixes(texts: pa.Array, parts: np.ndarray, lengths_in_bytes: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """hashed_words, and hashes of all words' first bytes, so many as given (a shorter word is all of it)."""
    data, offsets = utf8(texts)
    inside = ~parts[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    start[heads] |= inside[heads]
    at = np.flatnonzero(start)
    counts = np.diff(np.searchsorted(at, offsets))
    if not len(at):
        return [np.zeros(0, np.uint64) for _ in range(1 + len(lengths_in_bytes))], counts
    chars = np.flatnonzero(inside)
    first = np.flatnonzero(start[chars])
    lengths = np.diff(np.append(first, len(chars)))
    place = np.arange(len(chars)) - np.repeat(first, lengths)
    terms = _CODES[_FOLD[data[chars]]] * _power(int(lengths.max()))[place]
    hashes = [mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))]
    for k in lengths_in_bytes:
        hashes.append(mix(np.add.reduceat(np.where(place < k, terms, np.uint64(0)), first) + np.uint64(1000 + k)))
    return hashes, counts


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting (numpy's own function hashes, which is slower here)."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of sequences: left's grown by one item each."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def squeezed(x: np.ndarray) -> bytes:
    """Whole numbers, compressed with bytes of equal weight together."""
    x = x.astype(np.uint64)
    planes = x.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unsqueezed(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.Codec("zstd").decompress(data[8:], 8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def packed(sorted_hashes: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, whose high bytes are zero."""
    return squeezed(np.diff(sorted_hashes, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.add.accumulate(unsqueezed(data))
