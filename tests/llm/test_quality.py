import numpy as np
import pyarrow as pa

from axonweave.llm.quality import CumulativeLink, features, quality_scores, selected

DOCS, LABELS = ("/root/testdata/sf0.1/documents.parquet", "/root/testdata/sf0.1/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(DOCS), spark.read.parquet(LABELS)
    rest = labels.where("doc_id % 2 = 0")
    got = quality_scores(docs, labels.where("doc_id % 2 = 1")).join(rest, "doc_id").toPandas()
    good = (got.quality == 1) & (got.toxic == 0)
    assert (got.keep == good).mean() > 0.96
    assert got.keep[good].mean() > 0.99
    assert (~got.keep[got.toxic == 1]).mean() > 0.8
    assert got.expected_grade.between(0, 2).all()


def test_thresholds_are_ordered_and_grades_follow():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["a1", "b1", "c1"], 20)) + " bad" * int(g == 0) + " fair" * int(g == 1) for g in rng.integers(0, 3, 600)]
    grades = np.array([0 if "bad" in t else 1 if "fair" in t else 2 for t in texts])
    columns, counts = features(pa.array(texts))
    model = CumulativeLink.constant(grades, 3)
    assert abs(model.slopes(np.zeros(len(grades)), grades).sum()) < 1e-6
    model.refine(np.repeat(np.arange(len(counts)), counts), columns, grades)
    assert model.thresholds[0] < model.thresholds[1]
    grade, tail = model.predict(columns, counts)
    assert grade[grades == 0].mean() < grade[grades == 1].mean() < grade[grades == 2].mean()
    assert ((tail >= 0.5) == (grades == 2)).mean() > 0.98


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "x" * 100_000, 0), (None, "a", 0), (3, "x" * 100_000, 0)], "doc_id long, text string, grade int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len(quality_scores(docs, none).collect()) == 5 and selected(docs, none).count() == 5
    some = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 1, 0), (9, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_scores(docs, some).collect()
    assert len(rows) == 5 and all(0 <= r.tail_prob <= 1 for r in rows)
    assert selected(docs, some).columns == docs.columns
    assert quality_scores(docs.limit(0), some).collect() == []
