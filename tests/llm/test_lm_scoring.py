import math
import re
from collections import Counter

import pytest

import axonweave.llm.lm_scoring as lm

TEXTS = [(1, "the cat sat on the mat"), (2, "The cat SAT"), (3, None), (4, ""), (5, "one"), (6, "the the the the"), (7, "zebra\tcat sat on\nthe hat"), (7, "zebra\tcat sat on\nthe hat"), (8, "w " * 3000), (None, "a cat"), (9, "été É")]


def brute(rows, order, least=1, alpha=0.4, apart=True):
    docs = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for _, t in rows]
    grams = lambda w: Counter(tuple(w[i - n : i]) for n in range(1, order + 1) for i in range(n, len(w) + 1))
    every = Counter()
    for w in docs:
        every.update(grams(w))
    total = sum(map(len, docs))
    out = []
    for (d, _), w in zip(rows, docs):
        own = grams(w) if apart else Counter()
        count = lambda *g: every[g] - own[g]
        score = seen = 0
        for i in range(len(w)):
            top = min(order, i + 1)
            v, hit = math.log10(max(count(w[i]), 1)) - math.log10(max(total - len(w) * apart, 1)), count(w[i]) >= least
            for n in range(2, top + 1):
                g = tuple(w[i + 1 - n : i + 1])
                hit = count(*g) >= least
                v = math.log10(count(*g)) - math.log10(count(*g[:-1])) if hit else v + math.log10(alpha)
            score += math.floor(v * 1e6 + 0.5)
            seen += hit
        out.append((d, len(w), seen, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("chunk, apart, least", [(5, True, 1), (1_000_000, True, 2), (5, False, 2)])
def test_against_brute_force(spark, monkeypatch, order, chunk, apart, least):
    monkeypatch.setattr(lm, "CHUNK_WORDS", chunk)
    docs = spark.createDataFrame([(*r, 1, "x") for r in TEXTS], "doc_id long, text string, words int, stream string")
    assert sorted(map(tuple, lm.backoff_scores(docs, order, least, apart=apart).collect()), key=str) == brute(TEXTS, order, least, apart=apart)


def test_empty(spark):
    assert lm.backoff_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query(spark):
    from axonweave.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op4_stupid_backoff"](spark, folder).collect()), key=str) == brute(rows, 3)


def test_chunks_are_not_shuffled_again(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    plan = lm.backoff_scores(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # entries by bucket, totals by chunk
