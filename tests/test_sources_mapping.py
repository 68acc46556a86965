"""Feed ids wherever they lie, the JSON site list, suggestions and custom patterns."""

import json
import re

import pytest
from pyspark.sql import functions as F

from shopfold.operators.detect import apply_transform, suggest_columns
from shopfold.schema import DEFAULT_STATUS_MAPPINGS
from shopfold.session import scratch_path
from shopfold.sources.feed import read_feed, read_feed_ids
from shopfold.sources.sites import (column_mapping_rows, read_sites_json, status_mapping_rows,
                                    write_sites_json)

FEED = """<?xml version="1.0"?><rss xmlns:g="x"><channel><g:id>77</g:id>
<item><g:id><![CDATA[ 12 ]]></g:id><title><![CDATA[<g:id>999</g:id>]]></title></item>
<entry><G:ID>007</G:ID></entry><!-- <g:id>888</g:id> --><g:idea>1</g:idea><id>2</id>
<product><sub><g:Id a="1">
 9 9 </g:Id></sub></product><item><g:id>  </g:id><g:id/></item><item><g:id>77</g:id></item></channel></rss>"""


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / "data" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(tmp_path / "data")
    return write


def test_feed_ids_of_any_container_and_spelling(spark, folder):
    folder("source_site=a/chunk=0/feed.xml", FEED)
    path = folder("source_site=b/chunk=0/feed.xml", "<rss><channel><item/></channel></rss>")
    got = sorted(tuple(r) for r in read_feed(spark, path).collect())
    assert got == [("a", i) for i in ("007", "12", "77", "9 9")]


def test_feed_without_ids(spark, folder):
    path = folder("source_site=b/chunk=0/feed.xml", "<rss><channel><item/></channel></rss>")
    empty = read_feed_ids(spark, path)
    assert empty.count() == 0 and empty.columns == ["source_site", "raw_id"]


SITES = [
    {"id": "a", "name": "A", "platform": "gomag", "bigqueryTable": "orders_a", "credentials": {"apiKey": "secret"},
     "columnMapping": [{"sourceColumn": "id", "targetColumn": "order_id", "status": "confirmed"},
                       {"sourceColumn": "x", "targetColumn": "", "status": "ignored", "transform": "toNumber"}],
     "statusMapping": [], "syncSchedule": "0 6 * * *", "lookbackDays": 30, "enabled": True,
     "lastSyncAt": "2024-03-05T06:00:01.000Z", "lastSyncStatus": "success", "lastSyncRowCount": 7},
    {"id": "b", "platform": "woocommerce", "statusMapping": [
        {"sourceStatus": "Done", "targetStatus": "order_processed"},
        {"sourceStatus": "done", "targetStatus": "order_cancelled"}], "hourlySyncEnabled": True},
    {"id": "c", "platform": "unheard-of", "productFeedUrl": "https://x/feed.xml"}]


@pytest.mark.parametrize("lines", [False, True])
def test_json_site_list(spark, folder, lines):
    path = folder("sites.json", "[" + ",\n".join(map(json.dumps, SITES)) + "]" if not lines
                  else json.dumps(SITES))
    sites = read_sites_json(spark, path)
    assert not any("credential" in c.lower() or "secret" in c.lower() for c in sites.columns)
    rows = {r.site_id: r for r in sites.collect()}
    assert (rows["a"].enabled, rows["a"].lookback_days, rows["a"].last_sync_row_count) == (True, 30, 7)
    assert rows["a"].last_sync_at.isoformat() == "2024-03-05T06:00:01"
    assert (rows["b"].enabled, rows["b"].hourly_sync_enabled, rows["b"].lookback_days) == (False, True, None)
    listed = {}
    for r in status_mapping_rows(sites).orderBy("site_id", "pos").collect():
        listed.setdefault(r.site_id, []).append((r.source_status, r.target_status))
    assert listed == {"a": [tuple(m) for m in DEFAULT_STATUS_MAPPINGS["gomag"]],
                      "b": [("Done", "order_processed"), ("done", "order_cancelled")]}
    columns = [tuple(r) for r in column_mapping_rows(sites).orderBy("site_id", "pos").collect()]
    assert columns == [("a", 0, "id", "order_id", "confirmed", None), ("a", 1, "x", "", "ignored", "toNumber")]


def test_site_list_round_trip(spark, folder):
    sites = read_sites_json(spark, folder("sites.json", json.dumps(SITES)))
    path = scratch_path(spark, "sites_json", unique=True)
    write_sites_json(sites, path)
    again = read_sites_json(spark, path)
    assert sorted(map(str, again.collect())) == sorted(map(str, sites.collect()))


def test_detected_paths_of_deep_and_odd_json(spark):
    from shopfold.operators.detect import detect_paths
    deep = {"k": 1}
    for n in range(12):
        deep = {f"d{n}": deep, "}{\"": "{{"}
    docs = [json.dumps(d) for d in (
        deep, {"a": [], "b": {}, "c": None, "d": [1, {"x": [{"y": 1}], "z": {}}, {"w": 2}], "e": [[{"n": 1}]], "s": "{\\\"{"},
        {"a": [{"p": 1}]}, [1, {"x": 1}], 3, None)] + [None]

    def leaves(value, path):
        if isinstance(value, list):
            first = next((x for x in value if isinstance(x, dict)), None)
            return [path] if first is None else leaves(first, path)
        if not isinstance(value, dict):
            return [path]
        return [p for k, v in value.items() for p in leaves(v, f"{path}.{k}" if path else k)]

    want = {p for d in docs if d is not None and isinstance(json.loads(d), dict) for p in leaves(json.loads(d), "")}
    df = spark.createDataFrame([("s", "x", d) for d in docs], "source_site string, platform string, doc string")
    raw = df.select("source_site", "platform", F.try_parse_json("doc").alias("raw"))
    assert {r.path for r in detect_paths(raw).collect()} == want


def test_suggestions(spark):
    paths = ["order_id", "id", "orderDate", "line_items.sku", "line_items.quantity", "items.prices", "billing.email",
             "currency_code", "total", "zzz"]
    got = {r.source_column: (r.target_column, r.status, r.similarity) for r in suggest_columns(
        spark.createDataFrame([("s", p) for p in paths], "source_site string, path string")).collect()}
    assert got["order_id"] == ("order_id", "confirmed", 1.0)
    assert got["id"] == ("order_id", "unmapped", 1.0) and got["orderDate"] == ("order_date", "unmapped", 1.0)
    assert got["line_items.sku"][0] == "product_sku" and got["line_items.quantity"][0] == "product_quantity"
    assert got["items.prices"] == ("product_price", "unmapped", round(1 - 1 / 14, 4))
    assert got["total"][0] == "order_total"
    assert all(got[p] == ("", "unmapped", None) for p in ("billing.email", "currency_code", "zzz"))


def test_custom_patterns(spark):
    texts = ["SKU-0042/x", "none", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (r"[0-9]+", r"SKU-0*([0-9]+)", r"(?i)sku"):
        group = 1 if re.compile(pattern).groups else 0
        want = [m[group] if t and (m := re.search(pattern, t)) else None for t in texts]
        assert [r.v for r in df.select(apply_transform(F.col("t"), "regex:" + pattern).alias("v")).collect()] == want
    with pytest.raises(ValueError):
        apply_transform(F.col("t"), "no such transform")
