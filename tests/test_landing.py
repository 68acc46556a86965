"""The landing of the order tables: shuffles sized by the input, one shuffle of the text."""

import datetime as dt
import os

import pytest

from shopfold.session import MIN_PARTITIONS, size_shuffles
from shopfold.sources.landing import land_pages, order_documents, page_envelopes
from shopfold.sources.raw import read_raw_orders

KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    day = lambda k: dt.datetime(2000, 1 + (k or 0) % 2, 3)
    orders = [(k, k + 1, "FOP"[k % 3], 10.5 * k, day(k), "1-URGENT") for k in [*range(60), 5, 5]]
    orders += [(None, 1, "F", 1.0, day(0), "1-URGENT"), (700, 2, "F", 1.0, None, "1-URGENT")]
    lines = [(k, p, 1, n, float(n), 2.5 * n, 0.0, 0.0, "NR"[n % 2], "O", day(k))
             for k in [*range(50), 700, None] for n, p in ((1, 0), (2, 1), (2, 1), (3, 99))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(0, "zero", "#0", 0.0), (1, "one", "#1", 1.5)], "p_partkey long, p_name string, "
                          "p_brand string, p_retailprice double").write.parquet(f"{at}/part.parquet")
    return at


def test_partitions_follow_the_input(spark, tmp_path):
    before = spark.conf.get(KEY, None)
    try:
        spark.conf.unset(KEY)
        size_shuffles(spark, str(tmp_path))
        least = int(spark.conf.get(KEY))
        for name, size in (("orders", 1 << 30), ("lineitem", 7 << 30)):
            with open(tmp_path / f"{name}.parquet", "wb") as f:
                os.truncate(f.fileno(), size)  # a sparse file
        size_shuffles(spark, str(tmp_path))
        assert int(spark.conf.get(KEY)) > 5 * least
        size_shuffles(spark, f"{tmp_path}/none")  # a smaller input lowers nothing
        assert int(spark.conf.get(KEY)) > 5 * least
    finally:
        spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)


def test_text_is_shuffled_once_and_collected_after_shuffles(spark, tables):
    lines = page_envelopes(spark, tables)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("Exchange hashpartitioning(platform" in x for x in lines) == 1
    below = [y for x, y in zip(lines, lines[1:]) if "Exchange hashpartitioning" in x]
    assert below and not any("collect_list" in x for x in below)


def test_landing_holds_every_order_in_compressed_files(spark, tables, tmp_path):
    path = land_pages(spark, tables, str(tmp_path / "pages"))
    files = [f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)
    as_text = lambda df: sorted(map(str, df.collect()))
    landed = read_raw_orders(spark, path).selectExpr("source_site", "platform", "to_json(raw) AS doc")
    made = order_documents(spark, tables).where("source_site IS NOT NULL").selectExpr(
        "source_site", "platform", "to_json(parse_json(doc)) AS doc")
    assert landed.count() == 63 and as_text(landed) == as_text(made)


def test_landing_sizes_its_own_shuffles(spark, tables, tmp_path):
    """stream_upsert lands before it reads any other input: its landing can't count on an earlier call."""
    before = spark.conf.get(KEY, None)
    try:
        spark.conf.unset(KEY)
        land_pages(spark, tables, str(tmp_path / "pages"))
        assert int(spark.conf.get(KEY, None) or 0) >= MIN_PARTITIONS
    finally:
        spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)
