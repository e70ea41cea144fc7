import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from axonweave.llm.packing import PIECES, pack, pack_documents, sum_of_squares

TEXTS = [
    (0, "Hello, World!  it's 12 o'clock"), (1, None), (2, ""), (3, "Straße ÉCOLE İstanbul ΣΑΣ οδός"), (3, "Straße ÉCOLE İstanbul ΣΑΣ οδός"),
    (11, "don't it's 's 'tis (hi) \"quoted,\" _x_ ×y <b> <|x|> a<|startoftext|> 3rd A1b2 O'Reilly's ...'re we're' '' 'S Øre ÿ µ ª º"),
    (4, "a\x1cb \x85 c d é ́x"), (5, "<|endoftext|> x<|startoftext|>y"), (6, "word " * 9000), (7, "x" * 30_000), (8, "日本語 text 🙂"), (9, "a " * 2047), (10, "a " * 2048),
]


def check(rows, texts, limit=2048):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(doc, k, at, len(p := ids[at : at + limit]), zlib.crc32(np.array(p, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), limit))]
    assert sorted(r[:5] for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_against_whole_text_encoding(spark):
    docs = spark.createDataFrame([(d, t, "s", 5) for d, t in TEXTS], "doc_id long, text string, sequence_id string, length int")
    rows = pack_documents(docs).collect()
    n = check(rows, TEXTS)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 2048) + 1


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_few_bins():
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(1, 1200, 3000))[::-1]
    bins, _ = sum_of_squares(lengths, 2048)
    assert bins.max() + 1 <= 1.01 * lengths.sum() / 2048 + 1


def test_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(pack_documents(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_equal_rows_are_spread_over_groups(spark):
    """A third of all rows are equal and have no id: every group gets its share of them, and no row is lost."""
    n, groups = 12_000, 8
    rows = spark.range(n).selectExpr(
        "IF(id % 3 = 0, null, id) AS doc_id", "0 AS piece", "0L AS start", "IF(id % 3 = 0, 300L, 1 + id % 2048) AS length", "IF(id % 3 = 0, 7L, id) AS ids_crc32")
    assert rows.schema.simpleString() == spark.createDataFrame([], PIECES).schema.simpleString()
    got = pack(rows, group=n // groups).toPandas()
    assert len(got) == n and sorted(got.length) == sorted(r.length for r in rows.collect())
    ends = got.assign(end=got.offset + got.length).groupby("sequence_id").agg(end=("end", "max"), total=("length", "sum"))
    assert (ends.end == ends.total).all() and ends.end.max() <= 2048
    assert len(ends) <= 1.05 * got.length.sum() / 2048  # lengths above 1748 have too few small partners to fill all
    shares = got[got.doc_id.isna()].groupby(got.sequence_id // 2**40).size()
    assert len(shares) == groups and shares.max() < 1.3 * n / 3 / groups
