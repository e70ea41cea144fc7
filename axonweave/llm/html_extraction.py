"""Operator 9, HTML extraction: tag-path ratios choose the content blocks of a page.

A page becomes blocks of text with the tag path from the root to the block. Per path, text outside links and
punctuation are added up and divided by the number of blocks; both ratios are smoothed along the page, fused,
and compared with a threshold of the page. An article or main element is a weight in the fusion, by the share of
the page's text it holds. Blocks of paths that pass name their containers, whose other blocks (headings, short
lines) belong to the article too; paths of links alone do not. Parts that are furniture by the words of their class
or id, forms, and furniture elements that are never closed are weights in the fusion as well: a part that holds nearly
all of the page's text, with headings or paragraphs, is a wrapper and no furniture, and the less it holds the less it
counts. Furniture elements and roles that are closed, and hidden parts, do not count at all.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names and words that sites use.
RAW = frozenset("script style noscript template iframe object svg math textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math nobr output q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
FURNITURE = frozenset("nav footer aside button select menu dialog head fieldset audio video canvas datalist".split()) | RAW
WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification popup modal overlay "
    "sidebar widget widgets menu submenu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments commentlist disqus respond reply replies share sharing social "
    "related recommended recommendations newsletter subscribe subscription signup login search pagination pager paywall hidden skip toolbar".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
CONTAINERS = frozenset("article main body div section td center blockquote html".split())
KEPT = frozenset("html body main article".split())

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")
_HEADING = re.compile("h[1-6]$")
#: Weight of an article or main element that holds all text of the page, beyond 1.
ARTICLE = 24
#: Weight of a short line that states rights and of an article in a furniture part beside another article; a furniture
#: part with x of the page's text has weight x ** SHARE.
DOUBT, SHARE = 0.1, 4
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b)(?=.*\d{4})|.*\ball rights reserved\b", re.I)
_WEIGHTS = np.exp(-0.5 * np.arange(-2, 3) ** 2)
#: What a start tag closes if it is open.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BOUNDS = ("ul", "ol", "dl", "table", "article", "section", "body")


#: Kinds of furniture: none, by a word or a form, by its element or role, hidden.
_NONE, _WORDED, _ELEMENT, _HIDDEN = range(4)


def _furniture(tag: str, attributes: str, within: int) -> int:
    if tag == "head":
        return _HIDDEN
    if tag in FURNITURE or (tag == "header" and not within):
        return _ELEMENT
    kind = _WORDED if tag == "form" else _NONE
    if not attributes or tag in KEPT:
        return kind
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        words = re.findall("[a-z]+", value)
        if name in ("class", "id") and (not WORDS.isdisjoint(words) or ("header" in words and not within)):
            kind = max(kind, _WORDED)
        if name == "role" and value in ROLES and tag != "form":
            kind = max(kind, _ELEMENT)
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _HIDDEN
    return kind


class _Part:
    """A furniture part: kind, the part around it, its place among the open elements, whether it is within an article,
    whether its end tag came, and what it holds: unlinked characters, paragraphs, and headings, article or main elements."""

    __slots__ = ("kind", "around", "place", "within", "closed", "length", "paragraphs", "titled")

    def __init__(self, kind: int, around: _Part | None, place: int, within: bool):
        self.kind, self.around, self.place, self.within = kind, around, place, within
        self.closed, self.length, self.paragraphs, self.titled = False, 0, 0, False

    def out(self) -> bool:
        return self.kind == _HIDDEN or self.kind == _ELEMENT and self.closed


class _Block:
    __slots__ = ("path", "container", "within", "part", "parts", "linked")

    def __init__(self, path: int, container: int, within: int, part: _Part | None):
        self.path, self.container, self.within, self.part, self.parts, self.linked = path, container, within, part, [], 0


class _Open:
    """The open elements: name, path of blocks (a number), container, innermost furniture part, within an article
    (1: one below furniture by words, 2: another), under a link. Places by name make each step short."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, _Part | None, int, bool]] = [("", 0, 0, None, 0, False)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]

    def add(self, element: tuple[str, int, int, _Part | None, int, bool]) -> None:
        self.places.setdefault(element[0], []).append(len(self.stack))
        if element[0] not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(element)

    def last(self, name: str) -> int:
        return places[-1] if (places := self.places.get(name)) else 0

    def cut(self, place: int) -> None:
        """Close the element at a place and all within it; none at 0."""
        while place and len(self.stack) > place:
            name = self.stack.pop()[0]
            self.places[name].pop()
            if name not in INLINE:
                self.blocks.pop()

    def close(self, name: str) -> None:
        """An end tag; that of an inline element does not reach beyond its block."""
        place = self.last(name)
        if name not in INLINE or place > self.blocks[-1]:
            if (part := self.stack[place][3]) and part.place == place:
                part.closed = True
            self.cut(place)

    def shut(self, name: str) -> None:
        """What a start tag closes within the list, table or section that it stands in."""
        place = self.last(name)
        if place and place > max(self.last(b) for b in _BOUNDS if b != name):
            self.cut(place)


def blocks(page: str) -> list[tuple[str, int, int, bool, int, bool, float]]:
    """Text, tag path (a number), container, whether an article or main element speaks for it, linked characters,
    whether it is a heading, and its weight by the furniture around it, per block. Time and memory grow with the page's length, however deep its elements nest."""
    out: list[_Block] = []
    open_ = _Open()
    stack = open_.stack
    #: numbers of the paths by the path above and the name, and whether they end in a heading
    paths: dict[tuple[int, str], int] = {}
    heads = [False]
    furniture: list[_Part] = []
    spoken = False  # an article or main element stands outside all furniture
    block: _Block | None = None
    at, n = 0, 0

    def text(part: str) -> None:
        nonlocal block
        if stack[-1][0] == "head" and part.strip():  # its end tag may be left out
            open_.cut(open_.last("head"))
        name, path, container, held, within, link = stack[-1]
        if held and held.kind == _HIDDEN or not part:
            return
        if block is None:
            if not part.strip():
                return
            block = _Block(path, container, within, held)
            out.append(block)
        block.parts.append(html.unescape(part) if "&" in part else part)
        if link:
            block.linked += len(part.strip())

    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            block = None
        elif tag == "br" and block is not None:
            block.parts.append(" ")
        if closing:
            open_.close(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at) if not attributes.endswith("/") or tag not in ("svg", "math") else None
            at = end.end() if end else at if attributes.endswith("/") else len(page)
            continue
        if tag in VOID:
            continue
        if tag != "head":  # what may stand in a head was passed over before
            open_.cut(open_.last("head"))
        for name in _CLOSES.get(tag, ()):
            open_.shut(name)
        if tag not in INLINE:  # a block ends an open paragraph
            open_.shut("p")
        _, path, container, held, within, link = stack[-1]
        n += 1
        if tag not in INLINE:
            path = paths.setdefault((path, tag), len(heads))
            if path == len(heads):
                heads.append(bool(_HEADING.match(tag)))
        kind = _furniture(tag, attributes, within)
        if kind and not (held and held.kind == _HIDDEN):
            held = _Part(kind, held, len(stack), within == 2)
            furniture.append(held)
        if tag in ("article", "main"):
            spoken |= held is None
            within = 1 if held and held.kind == _WORDED else within or 2
            while held and held.kind == _WORDED:  # words do not reach an article below them
                held = held.around
        if held:
            held.paragraphs += tag == "p"
            held.titled |= tag in ("h1", "h2", "article", "main")
        open_.add((tag, path, n if tag in CONTAINERS else container, held, within, link or tag == "a"))
    joined = [(" ".join("".join(b.parts).split()), b) for b in out]
    return [(t, b.path, b.container, b.within == 2, b.linked, heads[b.path], w) for (t, b), w in zip(joined, _weights(joined, furniture, spoken)) if t and w]


def _weights(joined: list[tuple[str, _Block]], furniture: list[_Part], spoken: bool) -> Iterator[float]:
    """Each block's weight by the furniture parts around it: 0 in one that is out or stands beside an article (spoken),
    else the least share to the power SHARE."""
    out: dict[_Part | None, bool] = {None: False}
    for part in furniture:  # a part stands behind the one around it
        out[part] = part.out() or out[part.around]
    total = 0
    for t, b in joined:
        if not out[b.part]:
            total += (length := max(len(t) - b.linked, 0))
            if b.part:
                b.part.length += length
    for part in reversed(furniture):
        if part.around and not out[part]:
            part.around.length += part.length
            part.around.paragraphs += part.paragraphs
            part.around.titled |= part.titled
    weight: dict[_Part | None, float] = {None: 1.0}
    for part in furniture:
        own = 0.0 if out[part] or spoken and not part.within or not (part.titled or part.paragraphs >= 3) else (part.length / max(total, 1)) ** SHARE
        weight[part] = min(own, weight[part.around])
    for t, b in joined:
        yield weight[b.part] * (DOUBT if spoken and b.within == 1 or not b.within and len(t) <= 160 and _RIGHTS.match(t) else 1)


def _smooth(x: np.ndarray) -> np.ndarray:
    return np.convolve(x, _WEIGHTS, "same") / np.convolve(np.ones(len(x)), _WEIGHTS, "same") if len(x) >= len(_WEIGHTS) else x


def main_text(page: str, share: float = 0.5) -> str:
    """The article of one page: chosen blocks in page order, one per line. share: the threshold's share of the
    page's mean fused ratio, weighted by text."""
    found = blocks(page)
    if not found:
        return ""
    paths, place = np.unique([b[1] for b in found], return_inverse=True)
    length = np.array([max(len(b[0]) - b[4], 0) for b in found], float)
    marks = np.array([len(_PUNCTUATION.findall(b[0])) if len(b[0]) > b[4] else 0 for b in found], float)
    weight = np.array([b[6] for b in found])
    count = np.bincount(place, weights=weight)
    by_length, by_marks = (np.bincount(place, weights=weight * x) / count for x in (length, marks))
    fused = _smooth(by_length[place]) * (1 + _smooth(by_marks[place])) * weight
    inside = np.array([b[3] for b in found])
    if length.sum():
        fused = fused * np.where(inside, 1 + ARTICLE * length[inside].sum() / length.sum(), 1)
    threshold = share * np.average(fused, weights=length) if length.sum() else 0.0
    good = fused >= threshold
    by_path = np.bincount(place, weights=np.where(good, length, 0)) >= 0.5 * np.bincount(place, weights=length)
    textual = (by_length[place] > 0) | np.array([b[5] for b in found]) | (not length.sum())
    #: a block of links alone, and one in what may be furniture, needs its container or its own ratio
    free = weight >= share
    chosen = (good & ((length > 0) | inside | (not length.sum())) | by_path[place] & (length > 0) & free) & textual
    containers = {b[2] for b, c in zip(found, chosen) if c}
    textual &= free
    return "\n".join(b[0] for b, c, t in zip(found, chosen, textual) if c or t and b[2] in containers)


def extract(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, text, n_chars; a row for each row of pages.

    Null html is empty; text is empty if no block is content. Character references are decoded, white space
    within a block is one space, blocks are parted by one line feed; nothing else is dropped. Blocks of equal text
    all stay, in page order. Pages are read whole, in time in proportion to their length however deep elements nest.
    Repeated rows get equal results, other columns are ignored, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h or "") for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", "CAST(url AS STRING) AS url", "CAST(html AS STRING) AS html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
