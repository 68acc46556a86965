"""Flatteners: one raw order -> one row per line item.

All platforms are flattened in one pass: per-platform field rules become
per-row *candidate slots* (``CASE platform ...`` picks which JSON path fills
slot 1, slot 2, ...), and one generic ``a || b || default`` rule resolves the
slots.  The raw orders are scanned once and exploded once, with no shuffle.
Line items are filtered (GoMag services) *before* ``posexplode_outer`` so an
order without kept items still yields exactly one placeholder row, and the
raw document is dropped before the explode so it is not copied per item.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfold.functions.numeric import js_round2_sql
from shopfold.functions.values import (as_array, is_object, is_truthy, resolve_numbers,
                                       resolve_texts)
from shopfold.schema import DEFAULT_CURRENCY, STANDARD_COLUMNS
from shopfold.sources.raw import _values_in_key_order, as_list, in_key_order

def _slots(src: str, paths: list[str]) -> list[tuple[str, str]]:
    """(text, variant) SQL expressions of the candidate paths of one platform."""
    return [(f"variant_get(`{src}`, '$.{p}', 'string')", f"variant_get(`{src}`, '$.{p}', 'variant')")
            for p in paths]


def _per_platform(df: DataFrame, build, platforms: list[str] | None = None) -> DataFrame:
    """``build(df_of_platform, platform)`` for every platform, unioned by name.

    Each branch carries only its own platform's rules, which keeps every
    whole-stage-codegen method small (one branch with all platforms' CASE arms
    exceeds the JVM's 64 KB method limit and falls back to interpretation).
    On landed pages the platform is a partition column, so each branch reads
    only its own files: still one pass over the data.
    """
    from shopfold.schema import PLATFORMS
    out = None
    for p in platforms or PLATFORMS:
        b = build(df.filter(F.col("platform") == p), p)
        out = b if out is None else out.unionByName(b)
    return out


# Candidate paths per platform, in `a || b` order (fixed by the store formats).
ORDER_FIELDS = {
    "order_id": ({"woocommerce": ["id", "number"], "gomag": ["number", "id"],
                  "merchantpro": ["id"], "shopify": ["id"]}, ""),
    "order_date_text": ({"woocommerce": ["date_created", "date_created_gmt"],
                         "gomag": ["date"], "merchantpro": ["date_created", "created_at"],
                         "shopify": ["created_at"]}, ""),
    "order_status": ({"woocommerce": ["status"], "gomag": ["status"],
                      "merchantpro": ["shipping_status", "status"],
                      "shopify": ["fulfillment_status"]}, ""),
    "_total_text": ({"woocommerce": ["total"], "gomag": ["total"],
                     "merchantpro": ["total_amount", "total"], "shopify": ["total_price"]}, "0"),
    "currency": ({"woocommerce": ["currency"], "gomag": ["currency"],
                  "merchantpro": ["currency"], "shopify": ["currency"]}, DEFAULT_CURRENCY),
}
ITEM_FIELDS = {
    "product_id": ({"woocommerce": ["product_id"], "gomag": ["id", "product_id"],
                    "merchantpro": ["product_id"], "shopify": ["product_id"]}, ""),
    "product_sku": ({"woocommerce": ["sku"], "gomag": ["sku"],
                     "merchantpro": ["product_sku", "sku"], "shopify": ["sku"]}, ""),
    "product_name": ({"woocommerce": ["name"], "gomag": ["name"],
                      "merchantpro": ["product_name", "name"], "shopify": ["title"]}, ""),
    "_price_text": ({"woocommerce": ["price"], "gomag": ["price"],
                     "merchantpro": ["unit_price_gross", "unit_price_net", "price"],
                     "shopify": ["price"]}, "0"),
    "_qty_text": ({"woocommerce": ["quantity"], "gomag": ["quantity", "qty"],
                   "merchantpro": ["quantity"], "shopify": ["quantity"]}, "0"),
    "_line_text": ({"woocommerce": ["total"], "gomag": [],
                    "merchantpro": ["line_subtotal_gross", "line_subtotal_net"],
                    "shopify": []}, "0"),
}
# Shopify (documented only): an unfulfilled order carries a null status.
SHOPIFY_NULL_STATUS = "unfulfilled"


def _fields(src: str, spec: dict, platform: str) -> dict[str, tuple[list, str]]:
    out = {}
    for name, (table, default) in spec.items():
        paths = table.get(platform, [])
        out[name] = (_slots(src, paths), default)
    return out


GOMAG_ITEM_KEYS = ("items", "products", "line_items")


def _first_truthy(g: list[Column]) -> Column:
    return F.when(is_truthy(g[0]), g[0]).when(is_truthy(g[1]), g[1]).when(is_truthy(g[2]), g[2])


def _gomag_items(raw: Column) -> Column:
    """The first truthy of GoMag's item collections (an array, or an id-keyed object)."""
    return _first_truthy([F.variant_get(raw, f"$.{k}", "variant") for k in GOMAG_ITEM_KEYS])


def _items(platform: str) -> Column:
    """array<variant> of kept line items; NULL or empty -> placeholder row."""
    raw = F.col("raw")
    if platform != "gomag":
        return as_array(F.variant_get(raw, "$.line_items", "variant"))
    g_pick = _gomag_items(raw)
    return F.when(is_truthy(g_pick), F.filter(as_list(g_pick), lambda it: ~F.coalesce(
        F.variant_get(it, "$.type", "string") == "service", F.lit(False))))


def _item_fields(platform: str) -> dict[str, tuple[list, str]]:
    """Candidates of the exploded item: its text, and its variant where the JSON type decides."""
    out = {}
    for name, (table, default) in ITEM_FIELDS.items():
        out[name] = ([(f"`_item`.`text`.`{p}`", f"`_item`.`typed`.`{p}`")
                      for p in table.get(platform, [])], default)
    return out


def _texts(df: DataFrame, fields: dict[str, tuple[list, str]]) -> DataFrame:
    """resolve_texts, with fields that have no candidate set to their default."""
    empty = {n: d for n, (cs, d) in fields.items() if not cs}
    df = resolve_texts(df, {n: v for n, v in fields.items() if v[0]})
    for n, d in empty.items():
        df = df.withColumn(n, F.lit(d))
    return df


def order_headers(raw: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """Order-level fields (text rules applied, total parsed and rounded).

    ``platforms``: the platforms the frame can contain (from the site
    configuration); a branch is built for each.  Default: every platform.
    """
    extra = [c for c in raw.columns if c not in ("source_site", "platform", "raw")]

    def build(df: DataFrame, platform: str) -> DataFrame:
        orders = df.select("source_site", "platform", "raw", *extra)
        orders = _texts(orders, _fields("raw", ORDER_FIELDS, platform))
        if platform == "shopify":
            orders = orders.withColumn("order_status", F.when(
                F.col("order_status") == "", F.lit(SHOPIFY_NULL_STATUS)).otherwise(
                F.col("order_status")))
        orders = resolve_numbers(orders, {"_order_total": ("_total_text", "money")})
        return orders.selectExpr(
            "source_site", "platform", "raw", "order_id", "order_date_text", "order_status",
            "currency", f"{js_round2_sql('_order_total')} AS order_total",
            "try_to_timestamp(order_date_text) AS order_date", *[f"`{c}`" for c in extra])
    return _per_platform(raw, build, platforms)


def raw_item_lists(raw: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """Per order: all line items before the service filter, and the kept ones."""
    def build(df: DataFrame, platform: str) -> DataFrame:
        r = F.col("raw")
        if platform == "gomag":
            all_items = as_list(_gomag_items(r))
        else:
            all_items = as_array(F.variant_get(r, "$.line_items", "variant"))
        return df.select("*", all_items.alias("_all_items"), _items(platform).alias("_items"))
    return _per_platform(raw, build, platforms)


def flatten_orders(raw: DataFrame, as_of: _dt.datetime | str,
                   mappings: DataFrame | None = None,
                   platforms: list[str] | None = None) -> DataFrame:
    """(source_site, platform, raw) -> fact rows + helper columns.

    Helper columns: ``item_pos`` (position among kept items, for the
    last-item-wins dedup), ``platform``, ``order_date_text``,
    ``is_placeholder`` and ``reject_reason``.  ``synced_at`` is the one
    ``as_of`` of the run.  Rows whose date does not parse, or whose quantity
    is not a whole number, get a ``reject_reason`` (the warehouse would refuse
    them); :func:`accepted` / :func:`rejected` split on it.

    With ``mappings`` the status is normalised on the order headers, before
    the explode: it is an order-level field, so the lookup joins orders, not
    line items.
    """
    headers = order_headers(raw, platforms)
    if mappings is not None:
        from shopfold.operators.status import normalize_status
        headers = normalize_status(headers, mappings)
    return explode_items(headers, as_of, platforms)


def explode_items(headers: DataFrame, as_of: _dt.datetime | str,
                  platforms: list[str] | None = None) -> DataFrame:
    """Order headers (with ``raw``) -> one row per kept item or one placeholder.

    Order-level predicates (site, since window) applied to ``headers`` run
    before the explode: the order date is parsed here, upstream of Generate.
    """
    extra = [c for c in headers.columns if c not in (
        "raw", "source_site", "platform", "order_id", "order_date_text", "order_status",
        "currency", "order_total", "order_date")]
    return _per_platform(headers, lambda df, p: _explode_platform(df, p, extra, as_of),
                         platforms)


def _item_struct_type(platform: str, of: str) -> str:
    paths = ["type"] if platform == "gomag" else []
    for table, _ in ITEM_FIELDS.values():
        for p in table.get(platform, []):
            if p not in paths:
                paths.append(p)
    return "struct<" + ", ".join(f"`{p}`: {of}" for p in paths) + ">"


def _item_array(platform: str, of: str) -> Column:
    """All items as ``array<struct<field: of, ...>>``, in order.

    One cast of the whole array reads every needed field of every item
    without building a VARIANT per item and looking paths up in it again.
    If one element is not an object the whole-array cast yields NULL, so the
    per-element cast takes over (such an element becomes a row of defaults).
    GoMag's items were picked before (``_found``); the others are cast where they
    are in the order: taken out as a VARIANT, they would be built anew.
    """
    st = _item_struct_type(platform, of)

    def from_array(v: Column, path: str = "$") -> Column:
        return F.coalesce(F.try_variant_get(v, path, f"array<{st}>"), F.transform(
            as_array(F.variant_get(v, path, "variant")), lambda x: F.try_variant_get(x, "$", st)))
    if platform != "gomag":
        return from_array(F.col("raw"), "$.line_items")
    pick = F.col("_found")
    values = F.transform(_values_in_key_order(pick), lambda x: F.try_variant_get(x, "$", st))
    if of != "variant":  # texts can be sorted along with their keys
        values = F.coalesce(in_key_order(F.try_variant_get(pick, "$", f"map<string,{st}>")), values)
    return F.when(is_object(pick), values).otherwise(from_array(pick))


def _type_may_decide(platform: str, items: Column) -> Column:
    """False only where :func:`_type_decides` is false for every item: no text of a field in question
    starts like a falsy value.  A few functions of whole arrays, as the rule by itself is evaluated
    item by item without generated code."""
    def falsy(paths: list[str]) -> Column:
        return F.concat_ws("\n", *[items[p] for p in paths]).rlike(r"(?:^|\n)(?:false(?:\n|$)|[0.-])")
    always, found = [], F.lit(False)
    for name, (table, _) in ITEM_FIELDS.items():
        paths = table.get(platform, [])
        if not name.endswith("_text"):
            always += paths
        else:
            for i, p in enumerate(paths[:-1]):
                later = F.concat_ws(",", F.lit("x"), *[items[x] for x in paths[i + 1:]]) != "x"
                found = found | (later & falsy([p]))
    return falsy(always) | found


def _type_decides(platform: str, item: Column) -> Column:
    """Whether a rule of this item depends on the JSON type of a value: zero as a number is falsy
    and as a string truthy.  A number reads 0 either way unless a later candidate is there."""
    found = F.lit(False)
    for name, (table, _) in ITEM_FIELDS.items():
        paths = table.get(platform, [])
        for i, p in enumerate(paths):
            falsy = (item[p] == "false") | (F.substring(item[p], 1, 1).isin("0", "-", ".")
                                            & (item[p].try_cast("double") == 0.0))
            if name.endswith("_text"):
                later = [item[x].isNotNull() for x in paths[i + 1:]]
                if not later:
                    continue
                falsy = falsy & reduce(or_, later)
            found = found | F.coalesce(falsy, F.lit(False))
    return found


def _typed_items(orders: DataFrame, platform: str) -> DataFrame:
    """``raw`` replaced by ``_items``, the kept items as ``array<struct<text, typed>>``: the
    fields' texts, and their variants (NULL unless the JSON type of a value decides in the order,
    which is rare).  A variant carries the whole document's keys, so one per field and item would
    cost far more than the texts.  Each step is a column, so it is evaluated once."""
    keep = [c for c in orders.columns if c != "raw"]
    source = "raw"
    if platform == "gomag":
        source = "_found"
        orders = orders.select(*keep, *[F.variant_get("raw", f"$.{k}", "variant").alias(f"_in_{k}")
                                        for k in GOMAG_ITEM_KEYS])
        orders = orders.select(*keep, _first_truthy([F.col(f"_in_{k}") for k in GOMAG_ITEM_KEYS]).alias(source))
    texts = orders.select(*keep, source, _item_array(platform, "string").alias("_texts"))
    variants = F.when(_type_may_decide(platform, F.col("_texts"))
                      & F.exists("_texts", lambda x: _type_decides(platform, x)),
                      _item_array(platform, "variant"))
    none = F.array().cast(f"array<{_item_struct_type(platform, 'variant')}>")
    items = F.arrays_zip(F.col("_texts").alias("text"), F.coalesce(variants, none).alias("typed"))
    if platform == "gomag":  # service lines (item.type === 'service') are skipped before the explode
        items = F.filter(items, lambda x: ~F.coalesce(x["text"]["type"] == "service", F.lit(False)))
    return texts.select(*keep, items.alias("_items"))


def _explode_platform(headers: DataFrame, platform: str, extra: list[str], as_of) -> DataFrame:
    orders = _typed_items(headers.select(
        "source_site", "platform", "order_id", "order_date_text", "order_status", "currency",
        "order_total", "order_date", *extra, "raw"), platform)
    items = orders.select(
        "source_site", "platform", "order_id", "order_date_text", "order_status", "currency",
        "order_total", "order_date", *extra,
        F.posexplode_outer("_items").alias("item_pos", "_item"))
    items = _texts(items, _item_fields(platform))
    items = resolve_numbers(items, {"_price": ("_price_text", "money"),
                                    "_qty": ("_qty_text", "qty"),
                                    "_line": ("_line_text", "money")})
    if platform == "woocommerce":
        total = "_line"
    elif platform == "merchantpro":
        total = "CASE WHEN _line <> 0 THEN _line ELSE _price * _qty END"
    else:
        total = "_price * _qty"
    items = items.selectExpr(
        "*", "item_pos IS NULL AS is_placeholder",
        "CASE WHEN item_pos IS NULL THEN 0.0D ELSE _qty END AS _q",
        f"CASE WHEN item_pos IS NULL THEN 0.0D ELSE {js_round2_sql('_price')} END AS _p",
        f"CASE WHEN item_pos IS NULL THEN 0.0D ELSE {js_round2_sql(total)} END AS _t")
    whole = "(_q = floor(_q) AND abs(_q) < 9.2E18D)"
    blank = "CASE WHEN item_pos IS NULL THEN '' ELSE {c} END AS {c}"
    return items.selectExpr(
        "order_id", "order_date", "order_status", "order_total", "currency",
        blank.format(c="product_id"), blank.format(c="product_sku"),
        blank.format(c="product_name"),
        "_p AS product_price",
        f"CASE WHEN {whole} THEN CAST(_q AS BIGINT) END AS product_quantity",
        "_t AS product_total", "source_site",
        f"CAST(TIMESTAMP '{_ts_text(as_of)}' AS TIMESTAMP) AS synced_at",
        "coalesce(item_pos, 0) AS item_pos", "platform", "order_date_text", "is_placeholder",
        "CASE WHEN order_date IS NULL THEN 'order_date not a timestamp' "
        f"WHEN NOT {whole} THEN 'product_quantity not a whole number' END AS reject_reason",
        *[f"`{c}`" for c in extra])


def _ts_text(as_of) -> str:
    if isinstance(as_of, _dt.datetime):
        return as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(as_of)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNull())


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNotNull())


def fact_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*STANDARD_COLUMNS)


def placeholders(rows: DataFrame) -> DataFrame:
    """P5: the single row of orders without (kept) items."""
    return rows.filter(F.col("is_placeholder"))
