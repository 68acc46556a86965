"""The pipeline against plain Python versions of its stages, on a small documents table."""

import os

import pytest
from tables import clash, make_docs
from pyspark.sql import functions as F

import corpus_pipeline
from shopfold.llm import common
from test_decontamination import brute as brute_leaks
from test_line_dedup import brute as brute_lines
from test_simhash_dedup import brute_fp, brute_groups
from test_tokens import check_packing


@pytest.fixture
def small(spark, tmp_path, prose):
    """A documents and a benchmark table with copies, shared lines, a leak and blank texts."""
    item = prose(800, 25)
    shared = prose(801, 14)
    rows = [(k, f"{prose(k, 30 + k)}\n{shared}\n{prose(50 + k, 25)}") for k in range(20)]
    rows += [(30, rows[3][1]), (31, None), (32, ""), (33, "123 456"), (34, prose(90, 20) + " " + item + " " + prose(91, 20)),
             (35, prose(5, 35).replace(" ", "  ")), (36, shared), (37, "short")]
    docs = make_docs(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, [(1, item)]


def test_stages_and_run(spark, small):
    sf_dir, rows, items = small
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    docs = common.documents(spark, sf_dir)
    left = [(i, t) for i, t in rows if t is not None and any(c.isalpha() for c in t)]
    kept = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        docs = common.stored(out, f"test_{name}")
        if name == "line_dedup":
            done = brute_lines(left)
            left = [(i, done[i][0]) for i, _ in left if not (done[i][1] and not done[i][0].strip())]
        elif name == "simhash_dedup":
            roots, first = brute_groups([brute_fp(t) for _, t in left]), {}
            for (i, _), r in zip(left, roots):
                first[r] = min(first.get(r, i), i)
            left = [(i, t) for (i, t), r in zip(left, roots) if first[r] == i]
        elif name == "decontamination":
            bad = {i for i, _ in brute_leaks(left, items)}
            assert bad == {34}
            left = [(i, t) for i, t in left if i not in bad]
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(left), name
        kept.append(len(left))
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    got = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(left, got)
    assert kept[0] < len(rows) and kept[1] < kept[0]


def test_stages_take_odd_tables(spark, small, edge_docs):
    sf_dir, _, _ = small
    for docs in (clash(make_docs(spark, edge_docs)), make_docs(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            if name != "packing":
                assert out.columns == docs.columns
            out.collect()


def test_registered(spark):
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {"pipeline"} <= names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert os.path.exists(corpus_pipeline.__file__)
