"""Item fields are read as texts; the JSON type is looked up only where a rule depends on it."""

import datetime as dt
import json

from helpers import raw_df
from shopfold.operators.flatten import _typed_items, flatten_orders, order_headers

AS_OF = dt.datetime(2024, 5, 1)


def flat(spark, platform, docs):
    raw = raw_df(spark, [("s", platform, json.dumps(d)) for d in docs])
    return sorted((r.order_id, r.item_pos, r.product_id, r.product_sku, r.product_price, r.product_quantity,
                   r.product_total) for r in flatten_orders(raw, AS_OF, platforms=[platform]).collect())


def test_zero_as_number_is_falsy_and_as_string_truthy(spark):
    items = [{"product_id": 0, "sku": "0", "price": "2", "quantity": 3, "total": "6"},
             {"product_id": "0", "sku": False, "price": 2, "quantity": "3", "total": 6},
             {"product_id": "-0.0", "sku": "false", "price": 0, "quantity": 0, "total": 0}]
    assert flat(spark, "woocommerce", [{"id": 1, "line_items": items}]) == [
        ("1", 0, "", "0", 2.0, 3, 6.0), ("1", 1, "0", "", 2.0, 3, 6.0), ("1", 2, "-0.0", "false", 0.0, 0, 0.0)]


def test_a_later_candidate_counts_after_a_number_zero_only(spark):
    item = {"product_id": 7, "product_sku": 0, "sku": "later", "quantity": 1, "line_subtotal_gross": 5}
    docs = [{"id": n, "line_items": [item | {"unit_price_gross": zero, "price": 9}]} for n, zero in ((1, 0), (2, "0"))]
    assert flat(spark, "merchantpro", docs) == [
        ("1", 0, "7", "later", 9.0, 1, 5.0), ("2", 0, "7", "later", 0.0, 1, 5.0)]


def test_items_by_id_keep_javascripts_order(spark):
    items = {k: {"id": k, "sku": 0 if k == "9" else "x", "price": 1, "qty": 1} for k in ("b", "10", "9", "a", "01")}
    got = flat(spark, "gomag", [{"number": 1, "items": items}])
    assert [(x[2], x[3]) for x in got] == [("9", ""), ("10", "x"), ("01", "x"), ("a", "x"), ("b", "x")]
    odd = flat(spark, "gomag", [{"number": 1, "items": {"2": {"id": "p"}, "1": "no object"}}])
    assert [x[2] for x in odd] == ["", "p"]


def test_variants_are_built_only_where_a_type_decides(spark):
    plain = {"product_id": 5, "sku": "a", "price": 0, "quantity": 0, "total": 0}
    docs = [{"id": 1, "line_items": [plain]}, {"id": 2, "line_items": [plain, plain | {"sku": "0"}]}]
    raw = raw_df(spark, [("s", "woocommerce", json.dumps(d)) for d in docs])
    items = _typed_items(order_headers(raw, ["woocommerce"]).select("order_id", "raw"), "woocommerce")
    got = items.selectExpr("order_id", "exists(_items, x -> x.typed IS NOT NULL) AS typed").collect()
    assert {r.order_id: r.typed for r in got} == {"1": False, "2": True}


def test_no_method_is_too_large_to_be_compiled(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
