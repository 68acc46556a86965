"""Hand-written raw orders with the edge cases of FIXTURES.md §3."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import raw_df
from shopfold.operators.flatten import accepted, flatten_orders, rejected
from shopfold.operators.merge import dedup_latest, merge_status_only, merge_upsert
from shopfold.operators.status import normalize_status
from shopfold.schema import STANDARD_COLUMNS
from shopfold.sources.raw import unwrap_envelope

AS_OF = dt.datetime(2024, 3, 15, 6, 0, 0)


def flat(spark, docs):
    return flatten_orders(raw_df(spark, docs), AS_OF)


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_placeholders(spark):
    docs = [("s", "woocommerce", '{"id": 1, "date_created": "2024-03-01T10:00:00", "total": "5"}'),
            ("s", "woocommerce", '{"id": 2, "date_created": "2024-03-01T10:00:00", "line_items": []}'),
            ("g", "gomag", '{"number": 3, "date": "2024-03-01 10:00:00", '
                           '"items": [{"id": 9, "type": "service", "price": 5}]}'),
            ("g", "gomag", '{"number": 4, "date": "2024-03-01 10:00:00", "items": [], '
                           '"products": [{"id": 1, "price": 2, "quantity": 1}]}')]
    out = flat(spark, docs)
    got = rows_of(out, "order_id", "product_id", "product_quantity", "product_total",
                  "is_placeholder")
    assert got == [("1", "", 0, 0.0, True), ("2", "", 0, 0.0, True), ("3", "", 0, 0.0, True),
                   ("4", "", 0, 0.0, True)]


def test_gomag_object_items_in_numeric_key_order(spark):
    doc = ('{"number": 7, "date": "2024-03-01 10:00:00", "total": "10", "items": '
           '{"10": {"id": 10, "price": "1.5", "qty": "2"}, "9": {"id": 9, "price": 3, "quantity": 1}}}')
    out = flat(spark, [("g", "gomag", doc)])
    got = rows_of(out, "item_pos", "product_id", "product_price", "product_quantity",
                  "product_total")
    assert got == [(0, "9", 3.0, 1, 3.0), (1, "10", 1.5, 2, 3.0)]


def test_values_and_defaults(spark):
    doc = ('{"id": 5, "date_created": "2024-03-01T10:00:00", "total": "1.234,56 lei", '
           '"line_items": [{"product_id": 0, "price": 1.005, "quantity": 1, "total": "--5"},'
           '{"product_id": "0", "sku": "A", "price": "1e5", "quantity": "1", "total": 1.005}]}')
    out = flat(spark, [("s", "woocommerce", doc)])
    got = rows_of(out, "product_id", "order_total", "currency", "product_price", "product_total")
    assert got == [("", 1.23, "RON", 1.0, 0.0), ("0", 1.23, "RON", 15.0, 1.0)]


def test_merchantpro_subtotal_fallback(spark):
    doc = ('{"id": 8, "created_at": "2024-03-01T10:00:00", "status": "x", "shipping_status": "shipped",'
           '"total": 9, "line_items": [{"product_id": 1, "unit_price_net": "2.5", "quantity": 4, '
           '"line_subtotal_gross": 0}, {"product_id": 2, "price": 1, "quantity": 1, '
           '"line_subtotal_net": "7"}]}')
    out = flat(spark, [("m", "merchantpro", doc)])
    got = rows_of(out, "product_id", "order_status", "order_total", "product_total")
    assert got == [("1", "shipped", 9.0, 10.0), ("2", "shipped", 9.0, 7.0)]


def test_status_mapping_first_wins_case_insensitive(spark):
    docs = [("s", "woocommerce", '{"id": 1, "status": "COMPLETED", "date_created": "2024-03-01T10:00:00"}'),
            ("s", "woocommerce", '{"id": 2, "status": "weird", "date_created": "2024-03-01T10:00:00"}')]
    maps = spark.createDataFrame(
        [("s", 0, "completed", "order_processed"), ("s", 1, "Completed", "order_cancelled")],
        "site_id string, pos int, source_status string, target_status string")
    out = normalize_status(flat(spark, docs), maps)
    assert rows_of(out, "order_id", "order_status") == [("1", "order_processed"),
                                                        ("2", "[UNMAPPED] weird")]


def test_rejects(spark):
    docs = [("s", "woocommerce", '{"id": 1, "date_created": "not a date", "line_items": '
                                 '[{"product_id": 1, "quantity": 1}]}'),
            ("s", "woocommerce", '{"id": 2, "date_created": "2024-03-01T10:00:00+02:00", '
                                 '"line_items": [{"product_id": 1, "quantity": 1.5}]}'),
            ("s", "woocommerce", '{"id": 3, "date_created": "2024-03-01T10:00:00+02:00", '
                                 '"line_items": [{"product_id": 1, "quantity": 2}]}')]
    out = flat(spark, docs)
    assert rows_of(rejected(out), "order_id", "reject_reason") == [
        ("1", "order_date not a timestamp"), ("2", "product_quantity not a whole number")]
    good = accepted(out).collect()
    assert [r["order_date"] for r in good] == [dt.datetime(2024, 3, 1, 8, 0, 0)]


def test_dedup_last_item_wins(spark):
    doc = ('{"id": 1, "date_created": "2024-03-01T10:00:00", "line_items": ['
           '{"product_id": 5, "sku": "", "name": "first", "quantity": 1},'
           '{"product_id": 5, "sku": "", "name": "second", "quantity": 2}]}')
    rows = flat(spark, [("s", "woocommerce", doc)]).select(*STANDARD_COLUMNS, "item_pos")
    assert rows_of(dedup_latest(rows), "product_name", "product_quantity") == [("second", 2)]


def _fact(spark, rows):
    return spark.createDataFrame(
        [tuple(r) for r in rows],
        "order_id string, order_date timestamp, order_status string, order_total double, "
        "currency string, product_id string, product_sku string, product_name string, "
        "product_price double, product_quantity long, product_total double, source_site string, "
        "synced_at timestamp")


def test_merge_semantics(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    d = dt.datetime(2023, 12, 1)
    target = _fact(spark, [
        ("1", d, "a", 1.0, "RON", "p", "s", "n", 1.0, 1, 1.0, "x", t0),   # changed
        ("1", d, "a", 1.0, "RON", "p", "s", "n", 1.0, 1, 1.0, "x", t0),   # duplicate key
        ("2", d, "a", 2.0, "RON", "p", "s", "n", 1.0, 1, 1.0, "x", t0),   # target only
    ])
    source = _fact(spark, [
        ("1", d, "b", 9.0, "EUR", "p", "s", None, 9.0, 9, 9.0, "x", t1),  # NULL overwrites
        ("3", d, "b", 3.0, "RON", "p", "s", "n", 1.0, 1, 1.0, "x", t1),   # new
    ])
    up = merge_upsert(target, source).collect()
    got = sorted((r.order_id, r.order_status, r.order_total, r.product_name) for r in up)
    assert got == [("1", "b", 9.0, None), ("1", "b", 9.0, None), ("2", "a", 2.0, "n"),
                   ("3", "b", 3.0, "n")]
    st = merge_status_only(target, source).collect()
    got = sorted((r.order_id, r.order_status, r.order_total, r.synced_at) for r in st)
    assert got == [("1", "b", 1.0, t1), ("1", "b", 1.0, t1), ("2", "a", 2.0, t0)]
    # Upsert twice = once.
    once = merge_upsert(target, source)
    twice = merge_upsert(once, source)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_envelopes(spark):
    pages = [("g", "gomag", '{"total": "3", "orders": {"2": {"id": 2}, "10": {"id": 10}}}'),
             ("g", "gomag", '[{"id": 4}]'),
             ("g", "gomag", '{"orders": [], "x": 1}'),
             ("m", "merchantpro", '{"data": [{"id": 5}], "orders": [{"id": 6}]}'),
             ("m", "merchantpro", '{"orders": [{"id": 7}]}'),
             ("w", "woocommerce", '[{"id": 8}, {"id": 9}]'),
             ("w", "woocommerce", '{"orders": [{"id": 1}]}')]
    df = spark.createDataFrame(pages, "source_site string, platform string, p string").select(
        "source_site", "platform", F.parse_json("p").alias("page"))
    out = unwrap_envelope(df).select("source_site", F.variant_get("raw", "$.id", "int").alias("id"))
    assert rows_of(out, "source_site", "id") == [("g", 2), ("g", 4), ("g", 10), ("m", 5),
                                                ("m", 7), ("w", 8), ("w", 9)]
