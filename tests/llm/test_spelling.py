import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from axonweave.llm import spelling as S


def near(a, b):
    """One edit, by trying all of them that can help."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(docs, every=97):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(words):
    out = {}
    for w, n in words.items():
        others = [x for x in words if x != w and near(w, x)]
        form = min(others, key=lambda x: (-words[x], x)) if others else None
        form = form if form and words[form] >= 2 * n else None
        out[w] = [form, None, n, len(others), form and words[form]]
    for w in out:
        at = w
        while out[at][0]:
            at = out[at][0]
        out[w][1] = at
    return {w: tuple(v) for w, v in out.items()}


def rows_of(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


@pytest.mark.parametrize("few", (0, 5, 256))
def test_walk_against_all_pairs(few, monkeypatch):
    monkeypatch.setattr(S, "FEW", few)
    r = random.Random(few)
    for _ in range(80):
        groups = [sorted({"".join(r.choice("abé") for _ in range(r.randint(0, 7))) for _ in range(r.randint(1, 60))}) for _ in range(3)]
        texts = [w for g in groups for w in g]
        heads = np.zeros(len(texts), bool)
        heads[np.cumsum([0, *map(len, groups[:-1])])] = True
        of = np.cumsum(heads)
        got = sorted(zip(*(x.tolist() for x in S.walk(texts, heads, np.arange(len(texts))))))
        want = sorted((i, j, len(os.path.commonprefix([a, b]))) for i, a in enumerate(texts) for j, b in enumerate(texts) if of[i] == of[j] and near(a, b))
        assert got == want


def documents(seed):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdé") for _ in range(r.randint(4, 9))) for _ in range(60)]
    docs = []
    for i in range(40):
        words = []
        for _ in range(200):
            w = r.choice(stems)
            if r.random() < 0.3:
                at = r.randrange(len(w))
                w = r.choice((w[:at] + w[at + 1 :], w[:at] + r.choice("abx") + w[at:], w[:at] + r.choice("abz") + w[at + 1 :]))
            words.append(w.upper() if r.random() < 0.1 else w)
        docs.append((None if i % 13 == 0 else i, r.choice((" ", "1", "-\n", "×")).join(words)))
    return docs + [(77, None), (78, ""), (79, "Ärger ärger ÄRGER Ärger Ärger ärger ärger"), (79, "ÿÿÿÿÿ ÿÿÿÿÿ ÿÿÿÿÿ"), docs[5], docs[5]]


@pytest.mark.parametrize("group", (S.GROUP, 20, 2))
def test_against_brute_force(spark, group, monkeypatch):
    docs = documents(1)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    want = brute(counts(docs))
    assert len(want) > 200 and sum(v[0] is not None for v in want.values()) > 50
    assert rows_of(S.spelling_variants(frame, group=group)) == want


def test_one_group_holds_most_words(spark):
    r = random.Random(4)
    words = {"aaaaaa" + "".join(r.choice("abcd") for _ in range(r.randint(0, 6))): r.randint(3, 90) for _ in range(1500)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {w: v for w, v in brute(words).items() if v[3]}
    for group in (S.GROUP, 50):
        got = {r.word: r for r in S.near_words(frame, group).collect()}
        assert {w: r.n_near for w, r in got.items()} == {w: v[3] for w, v in want.items()}
        assert all(got[w].form == v[0] for w, v in want.items() if v[0])
    sizes = S.grouped(frame, 50).groupBy("key", "short").count().where("short >= 2")
    assert sizes.agg({"count": "max"}).first()[0] <= 50


def test_long_words_and_empty_tables(spark):
    a, b = "x" * 30_000, "x" * 29_999
    docs = [(i, f"{a} {b} {b}y {'ab' * 10_000}") for i in range(3)]
    got = rows_of(S.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(counts(docs))
    assert S.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_ties_and_chains(spark):
    words = {"abcde": 3, "abcdf": 6, "abcdg": 6, "abcxg": 12, "abyxg": 30, "zzzzz": 5, "zzzzy": 9}
    docs = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    got = rows_of(S.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"), every=10**10))
    assert got["abcde"] == ("abcdf", "abcdf", 3, 2, 6) and got["abcdg"] == ("abcxg", "abyxg", 6, 3, 12) and got["zzzzz"] == (None, "zzzzz", 5, 1, None)
    assert got == brute(words)
