from zlib import crc32

from axonweave.llm import language_id as L
from axonweave.llm.language_id import identify


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.98
    assert got.score.between(0, 1).all()


def test_edges(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de"), ("la maison et le jardin", "fr"), ("la casa y el jardin", "es"), ("kala ja vesi", "xx")] * 8)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 !?", "fr"), (103, "x", None), (104, "été", None), (105, "日本", None), (None, "the", "en"), (106, "und der " * 40_000, None), (106, "und der " * 40_000, None)]
    docs = spark.createDataFrame([(*r, "s", True) for r in rows], "doc_id long, text string, lang string, source string, held_out boolean")
    got = identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[106].lang_pred == "de" and by[105].lang_pred != "und"
    assert all(by[i].lang_pred == rows[i][2] for i in range(40))
    none = identify(docs.where("lang is null")).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert identify(docs.limit(0)).collect() == []


def test_one_language(spark):
    docs = spark.createDataFrame([(i, f"the cat and the dog number {i} are here", "en") for i in range(20)] + [(50, "12 34", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs).collect()}
    assert got.pop(50) == ("und", 0.0) and set(got.values()) == {("en", 1.0)}


def test_many_rows_under_one_id(spark):
    """Of one id's texts and of repeated rows, no more than the sample are fitted, whatever the id's hash."""
    ids = [i for i in range(40) if crc32(str(i).encode()) % 4 != 2][:6]
    for hot in ids[:3]:
        rows = [(hot, f"the cat and the dog {i % 700} are in the house", "en") for i in range(3_000)] + [(ids[5], f"der hund und die katze {i} sind im haus", "de") for i in range(50)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        got = identify(docs, sample=40)
        assert got.count() == 3_050 and {(r.doc_id, r.lang_pred) for r in got.select("doc_id", "lang_pred").distinct().collect()} == {(hot, "en"), (ids[5], "de")}


def test_no_more_than_the_sample_is_fitted(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "Hierarchy", lambda x, langs: seen.append(sorted(langs.tolist())))
    docs = spark.createDataFrame([(1, f"text {i % 90}", "en") for i in range(2_000)] + [(2, "same", "de")] * 500, "doc_id long, text string, lang string")
    L.fit_languages(docs, 30)
    assert seen == [["de"] + ["en"] * 30]
