"""Operator 7, secret scans: base patterns, and strings whose characters are too evenly spread.

Beyond the base patterns, candidate strings are parted from the words that stand beside them (the folders of a path,
the prefix of a name), and what is left is read by a sliding window. The window's Shannon entropy and its counts per
character class change by one character in and one out; windows that reach the threshold of their classes make a
span, unless the allow list knows the string found. All steps are linear in the text's length.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

# The kinds in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
HINTS = ("passw", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
WINDOW = 20
#: Bits per character from which a window is hot, by the characters in it. Set between what strings of words reach
#: and what random strings of the class do (figures in the README); windows without letters are never hot.
HEX_BITS, ONE_CASE_BITS, MIXED_LETTERS_BITS, DIGITS_ONE_CASE_BITS, OTHER_BITS = 3.05, 3.5, 3.7, 3.5, 3.75
UNIQUE_ID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Parts between signs that can be words: one case, a capital first, or camel case, with a few digits behind.
WORD = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[A-Z]?[a-z]{2,}(?:[A-Z]{1,3}[a-z]{2,})+)?[0-9]{0,4}")
SHORT = 4
#: Words that show a string to be made up.
MADE_UP = ("example", "sample", "dummy", "placeholder", "changeme")
# Pairs of letters that are frequent in words of European languages.
PAIRS = frozenset(
    "ac ad ag ai al am an ap ar as at au av ba be bi bl bo br bu ca ce ch ci ck co cr ct cu da de di do du ea ec ed ee ei el em en ep er es et ev ex "
    "fa fe ff fi fo fr ge gh gr ha he hi ho ht ic id ie if ig il im in io ir is it iv ke la ld le li ll lo ly ma me mi mm mo mp mu "
    "na nc nd ne ng ni no ns nt nu oc od of ol om on oo op or os ot ou ov ow pa pe pl po pr qu ra re ri rm ro rs rt ry sc se sh si so sp ss st su "
    "ta te th ti to tr ts tt ty ul um un up ur us ut va ve vi wa we wi wo".split()
)
#: Share of the pairs within words that are frequent, from which a string reads as words.
READS = 0.5

_VALUE = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
#: A character's place among the counts per class: digit, A-F, other capital, a-f, other small letter, sign.
_CLASS = {c: k for k, cs in enumerate(("0123456789", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "abcdef", "ghijklmnopqrstuvwxyz", "+/_-=")) for c in cs}


def readable(text: str) -> bool:
    """Whether a string's letters read as words: enough of it is letters, and most of their pairs are frequent ones.
    A small letter before a capital ends a word."""
    pairs = [x + y for x, y in zip(text, text[1:]) if x.isalpha() and y.isalpha() and not (x.islower() and y.isupper())]
    return 2 * len(pairs) >= len(text) and sum(p.lower() in PAIRS for p in pairs) >= READS * len(pairs)


def allowed(text: str) -> bool:
    """Whether a string is no secret however it is spread: a unique id, made up, an alphabet, or words."""
    low = text.lower()
    steps = sum(ord(y) - ord(x) == 1 for x, y in zip(text, text[1:]))
    return bool(UNIQUE_ID.fullmatch(text)) or any(w in low for w in MADE_UP) or 2 * steps >= len(text) or readable(text)


def pieces(text: str) -> Iterator[tuple[int, int]]:
    """What is left of a candidate between the words in it, from WINDOW characters on. Words of up to SHORT
    characters count only at its ends, as signs may stand so close in a secret too."""
    if UNIQUE_ID.fullmatch(text):
        return
    found = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9]+", text)]
    short = [b - a <= SHORT and bool(WORD.fullmatch(text, a, b)) for a, b in found]
    long = [b - a > SHORT and bool(WORD.fullmatch(text, a, b)) and (readable(part := text[a:b].rstrip("0123456789")) or part.lower() in MADE_UP) for a, b in found]
    low, high = 0, len(found)
    while low < high and (short[low] or long[low]):
        low += 1
    while low < high and (short[high - 1] or long[high - 1]):
        high -= 1
    if low == high:
        return
    start, end = found[low][0] if low else 0, found[high - 1][1] if high < len(found) else len(text)
    for k in range(low, high):
        if long[k]:
            if found[k][0] - start >= WINDOW:
                yield start, found[k][0]
            start = found[k][1]
    if end - start >= WINDOW:
        yield start, end


def threshold(classes: list[int]) -> float:
    """The bits from which a window with these counts per class is hot."""
    digits, hex_upper, upper, hex_lower, lower, signs = classes
    big, small = hex_upper + upper, hex_lower + lower
    if not big + small:
        return math.inf
    if digits and not signs and not upper + lower:
        return HEX_BITS
    one_case = big <= 1 or not small
    if not digits and not signs:
        return ONE_CASE_BITS if one_case else MIXED_LETTERS_BITS
    return DIGITS_ONE_CASE_BITS if one_case and not signs else OTHER_BITS


def hot_windows(text: str) -> Iterator[tuple[int, int]]:
    """Unions of the windows whose entropy reaches the threshold of their classes. The sum of c * log2 c over the
    window's characters and the counts per class are kept up by one step in and one step out."""
    counts: dict[str, int] = dict.fromkeys(text, 0)
    classes = [0] * 6
    total, first, last = 0.0, None, 0
    for i, c in enumerate(text):
        if i >= WINDOW:
            old = text[i - WINDOW]
            k = counts[old]
            total -= _VALUE[k] - _VALUE[k - 1]
            counts[old] = k - 1
            classes[_CLASS[old]] -= 1
        k = counts[c]
        total += _VALUE[k + 1] - _VALUE[k]
        counts[c] = k + 1
        classes[_CLASS[c]] += 1
        if i >= WINDOW - 1 and math.log2(WINDOW) - total / WINDOW >= threshold(classes) - 1e-9:
            start = i - WINDOW + 1
            if first is not None and start > last:
                yield first, last
                first = None
            first, last = start if first is None else first, i + 1
    if first is not None:
        yield first, last


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points."""
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return sorted(found)


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans beyond base; they overlap neither base spans nor each other."""
    out: list[tuple[int, int, int]] = []
    starts = [s for s, _, _ in base]
    ends = list(accumulate((e for _, _, e in base), max))  # the furthest end of all base spans that start so early
    for m in CANDIDATE.finditer(text):
        for first, last in pieces(m[0]):
            for a, b in hot_windows(m[0][first:last]):
                a, b = a + m.start() + first, b + m.start() + first
                before = bisect_left(starts, b)
                if not (before and ends[before - 1] > a) and not allowed(text[a:b]):
                    out.append((a, 3, b))
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_assign, n_access, n_hex, base_sha256, spans; a row for each row of docs.

    Null text is empty. spans are kind:start:end by start, then kind, comma-joined; places count code points
    from 0 and ends are exclusive. Spans of kind entropy never overlap base spans; of spans that start at one place
    the kind listed first comes first. Texts are read whole, in time in proportion to their length. Repeated rows
    get equal results; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("text"):
                t = text.as_py() or ""
                base = base_spans(t)
                counts = [sum(s[1] == k for s in base) for k in range(3)]
                rows.append((*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(base + entropy_spans(t, base))))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
