"""Operators 4 and 10: held-out accuracy and defined cases."""

import random

import numpy as np
from tables import clash, make_docs
from pyspark.sql import functions as F

from shopfold.llm import language_id, quality
from shopfold.llm.common import documents, labels

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = documents(spark, SF)
    got = language_id.language_id(docs)
    both = got.join(docs, "doc_id").filter("held_out AND lang IS NOT NULL")
    row = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert row[0] > 0.98 and row[1] > 100
    want = docs.select(F.sum((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).cast("int"))).first()[0]
    assert got.filter("held_out").count() == want and got.count() == docs.count()
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_language_ignores_other_columns(spark):
    docs = documents(spark, SF).limit(60)
    model = language_id.train(documents(spark, SF), 50)
    a = language_id.predict(docs, model)
    b = language_id.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model)
    assert sorted(a.collect()) == sorted(b.collect())


def test_sample_takes_a_repeated_id_once(spark, prose):
    rows = [(7, prose(k, 30), "en") for k in range(60)] + [(100 + k, prose(500 + k, 30), "en") for k in range(40)]
    rows += [(300 + k, prose(900 + k, 30).upper(), "xx") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    first = min((r for r in docs.filter("doc_id = 7").withColumn("h", F.xxhash64("text")).collect()), key=lambda r: r.h)
    once = spark.createDataFrame([(7, first.text, "en"), *(r for r in rows if r[0] != 7)], docs.schema)
    for per_language in (1500, 12):
        a, b = language_id.train(docs, per_language), language_id.train(once, per_language)
        assert list(a) == list(b) == ["en", "xx"] and all((a[k] == b[k]).all() for k in a)


def test_mixture_shares(spark):
    docs = documents(spark, SF).filter("n_chars > 1500")
    model = language_id.train(documents(spark, SF), 100)
    one = docs.filter("lang = 'en'").first().text[:1500]
    two = docs.filter("lang = 'de'").first().text[:700]
    rows = {r.doc_id: r for r in language_id.predict(make_docs(spark, [(1, one), (2, one + "\n" + two)]), model).collect()}
    assert rows[1].lang_pred == "en" and rows[1].n_langs == 1 and rows[1].score > 0.99
    assert rows[2].lang_pred == "en" and rows[2].n_langs == 2 and 0.55 < rows[2].score < 0.8


def test_language_evidence(spark):
    """Texts of no learned language stand apart from all texts of the learned ones."""
    r = random.Random(5)
    docs = documents(spark, SF)
    model = language_id.train(docs.filter(~language_id.held_out()))
    noise = "".join(r.choices("abcdefghijklmnopqrstuvwxyz    ", k=600))
    other = "Дети играют в саду, пока их родители готовят обед под фруктовыми деревьями."
    rows = {x.doc_id: x for x in language_id.predict(make_docs(
        spark, [(1, noise), (2, other), (3, "xq zzkw"), (4, "123"), (5, None)]), model).collect()}
    assert rows[1].evidence < -2 and rows[2].evidence < -2
    assert rows[3].evidence is None and rows[3].lang_pred != "und"
    assert rows[4].evidence is None and rows[5].evidence is None
    known = language_id.predict(docs.filter(language_id.held_out()), model)
    assert known.agg(F.min("evidence")).first()[0] > -2


def test_language_edge_cases(spark, edge_docs):
    got = language_id.language_id(clash(make_docs(spark, edge_docs))).collect()
    assert len(got) == len(edge_docs)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for i in (8, 9, 10, 11, 17):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[12].lang_pred == "en"
    nothing = make_docs(spark, edge_docs).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_id(nothing).collect()} == {"und"}
    assert language_id.language_id(make_docs(spark, [])).count() == 0


def test_quality_held_out(spark):
    docs, rated = documents(spark, "/root/testdata/sf0.1"), quality.graded(labels(spark, "/root/testdata/sf0.1"))
    got = quality.grade_documents(docs, labels(spark, "/root/testdata/sf0.1"))
    rows = got.join(rated, "doc_id").filter("held_out").select("grade", "kept", "expected_grade").collect()
    kept = {g: np.mean([r.kept for r in rows if r.grade == g]) for g in (0, 1, 2)}
    assert kept[0] < 0.1 and kept[1] < 0.1 and kept[2] > 0.95, kept
    mean = {g: np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)}
    assert mean[0] < mean[1] < mean[2]
    assert got.count() == docs.count()


def test_quality_edge_cases(spark, edge_docs):
    docs = clash(make_docs(spark, edge_docs))
    label = spark.createDataFrame([(3, 1, 0), (16, 0, 0), (16, 1, 0), (12, 0, 1), (999, 1, 0), (None, 1, 0), (14, None, None)],
                                  "doc_id long, quality int, toxic int")
    got = quality.grade_documents(docs, label).collect()
    assert len(got) == len(edge_docs) and all(r.expected_grade is not None for r in got)
    none = quality.grade_documents(docs, label.limit(0)).collect()
    assert all(r.kept and r.expected_grade is None for r in none) and len(none) == len(edge_docs)
    assert quality.grade_documents(make_docs(spark, []), label).count() == 0


def test_ordinal_regression_recovers_order():
    r = np.random.default_rng(1)
    w = np.array([2.0, -3.0, 0.0])
    x = r.normal(size=(3000, 3))
    score = x @ w + r.logistic(size=3000)
    grades = np.digitize(score, [-2.0, 0.5, 2.5])
    at = (1 << quality.BUCKET_BITS) + np.arange(3)  # measures: numbers that are not scaled
    model = quality.fit([at] * 3000, list(x), grades)
    fitted = model.weights[at]
    assert (np.diff(model.thresholds) > 0).all()
    assert abs(fitted[0] - 2) < 0.4 and abs(fitted[1] + 3) < 0.5 and abs(fitted[2]) < 0.2
    tails = model.tails(x @ w)
    assert (np.diff(tails, axis=1) <= 0).all()
