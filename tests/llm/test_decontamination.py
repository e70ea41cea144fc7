import hashlib
import re

from axonweave.llm.decontamination import contamination, item_windows, matches, positional_index
from pyspark.sql import functions as F


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width, 0) + 1):
            if w:
                windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for p, owners in windows.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    names |= owners
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
DOCS = [
    (1, f"x {LONG} y"), (2, LONG.upper().replace(" ", ", ")), (3, None), (4, ""), (5, "!!! ..."), (6, "the the the the the the"), (7, "École à l'été"), (8, "école à l'été"),
    (9, " ".join(LONG.split()[:12])), (10, " ".join(LONG.split()[1:14])), (11, "w " * 5000 + LONG), (12, LONG + " zz " * 300), (12, LONG + " zz " * 300), (1, "no match"), (13, "K kelvin"),
]
ITEMS = [(2, LONG), (10, "the the the"), (3, "École à"), (4, None), (5, "..."), (10, "the the the"), (6, LONG), (7, "k")]


def result(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, item_id int, pos int")
    return sorted(map(tuple, contamination(d, spark.createDataFrame(items, "item_id long, text string")).collect()), key=str)


def test_against_brute_force(spark):
    assert result(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_empty_tables(spark):
    assert result(spark, [], ITEMS) == []
    assert result(spark, DOCS[:4], []) == brute(DOCS[:4], [])


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red big green blue"), (2, "green red blue"), (3, "red a b c green blue")], "doc_id long, text string")
    windows, _ = item_windows(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"), 13)
    terms = windows.select(F.explode("words").alias("term")).select(F.monotonically_increasing_id().alias("term_id"), "term", F.lower("term").alias("folded"))
    from axonweave.llm._tables import store

    terms = store(terms)
    postings = positional_index(docs, terms).where("term_id is not null").select("doc_id", "text_key", "pos", "term_id")
    found = lambda slop: sorted({r.doc_id for r in matches(postings, windows, terms, slop).collect()})
    assert found(0) == []
    assert 1 in found(1) and 3 not in found(1)
