from pyspark.sql import functions as F

import corpus_pipeline as cp
from test_decontamination import brute as brute_contamination
from test_jaccard import brute as brute_components
from test_pii import base

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = cp.quality(spark, docs, SF)
    kept.write.parquet(str(tmp_path / "0"))
    kept = spark.read.parquet(str(tmp_path / "0"))
    assert kept.columns == columns and 0 < kept.count() < docs.count()

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = {d for d, _, c in brute_components(rows, cp.WIDTH, cp.PERCENT) if d == c}
    first = cp.near_copies(spark, kept, SF)
    first.write.parquet(str(tmp_path / "1"))
    first = spark.read.parquet(str(tmp_path / "1"))
    assert first.columns == columns and {r.doc_id for r in first.collect()} == want and first.count() == len(want)

    rows = [(r.doc_id, r.text) for r in first.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute_contamination(rows, items) if not r[5]}
    left = cp.decontamination(spark, first, SF)
    left.write.parquet(str(tmp_path / "2"))
    left = spark.read.parquet(str(tmp_path / "2"))
    assert left.columns == columns and {r.doc_id for r in left.collect()} == clean

    hidden = cp.personal_data(spark, left, SF)
    assert hidden.schema.simpleString() == docs.schema.simpleString() and hidden.count() == left.count()
    texts = {r.doc_id: r.text for r in left.collect()}
    for r in hidden.collect():
        assert not base(r.text) and r.n_chars == len(r.text)
        assert (r.text == texts[r.doc_id]) == (not base(texts[r.doc_id])) or "[" in r.text


def test_run(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x", "en", "s", 1)], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() >= 1
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_exact_rows_with_odd_ids(spark):
    """Rows without id, two texts under one id, repeated rows, null texts, and a column more."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").orderBy("item_id").first().text
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    rows = [
        (1, words("a", 40)), (1, words("b", 40)), (None, words("a", 40)), (None, words("c", 40)), (None, words("c", 40)), (7, words("c", 40)), (9, words("d", 40)), (9, words("d", 40)),
        (2, None), (3, None), (4, " "), (5, item), (None, item + " end"), (5, words("e", 40)),
    ]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).withColumn("_row_no", F.lit(1)).withColumn("component_id", F.lit("x"))
    show = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    first = cp.near_copies(spark, docs, SF)
    assert first.columns == docs.columns
    assert show(first) == sorted([(1, words("a", 40)), (1, words("b", 40)), (7, words("c", 40)), (9, words("d", 40)), (2, None), (3, None), (4, " "), (5, item), (5, words("e", 40))], key=str)
    clean = cp.decontamination(spark, docs, SF)
    assert clean.columns == docs.columns and show(clean) == sorted([r for r in rows if item not in (r[1] or "")], key=str)
    assert show(cp.personal_data(spark, docs, SF)) == sorted([(d, t) for d, t in rows if item not in (t or "")] + show(cp.personal_data(spark, docs.where(docs.text.contains(item)), SF)), key=str)
    assert sorted((r.doc_id for r in cp.packing(spark, docs, SF).collect()), key=str) == sorted((d for d, _ in rows), key=str)


def test_near_copies_of_five_words(spark, tmp_path):
    def text(name, n, changed=()):
        return " ".join(f"{name}x{i}" if i in changed else f"{name}{i}" for i in range(n))

    texts = {1: text("a", 102), 2: text("a", 102, (30, 70)), 3: text("b", 1000), 4: text("b", 1000, range(25, 1000, 50)), 5: text("c", 100), 6: text("c", 115), 7: text("d", 60), 8: text("d", 60, (20, 40))}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], spark.read.parquet(f"{SF}/documents.parquet").schema)
    assert sorted(r.doc_id for r in cp.near_copies(spark, docs, SF).collect()) == [1, 3, 5, 7, 8]

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(d for d, _, c in brute_components(rows, 5, 80) if d == c)
    assert sorted(r.doc_id for r in cp.near_copies(spark, docs, SF).collect()) == want


def test_columns_named_as_helpers_and_maps(spark):
    words = " ".join(f"w{i}" for i in range(40))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").orderBy("item_id").first().text
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(1, words, "en", "s", 1), (2, words, "en", "s", 1), (3, None, "en", "s", 0), (4, item, "en", "s", 1)], schema)
    names = ("_text", "_row", "_group", "_times", "row", "text_key", "row_key", "worded", "group", "times", "d", "t")
    docs = docs.withColumns({n: F.concat(F.lit("mine "), F.col("doc_id")) for n in names} | {"m": F.create_map(F.lit("k"), F.col("doc_id"))})
    for stage, ids in ((cp.near_copies, [1, 3, 4]), (cp.decontamination, [1, 2, 3]), (cp.personal_data, [1, 2, 3, 4])):
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        rows = got.collect()
        assert sorted(r.doc_id for r in rows) == ids and all(r[n] == f"mine {r.doc_id}" for r in rows for n in names) and all(r.m == {"k": r.doc_id} for r in rows)
