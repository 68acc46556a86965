"""Raw-order source: landed API pages -> one VARIANT per order.

S1 read_raw_orders   : JSON lines read straight into a single VARIANT column.
S2 unwrap_envelope   : the platform's page envelope -> its orders.
S3 total_available   : reported total per site (MerchantPro falls back to the
                       number of fetched orders).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.functions.values import (as_array, as_object, is_object, is_truthy,
                                       text_of)


def read_pages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """(page VARIANT, platform, source_site) from ``platform=/source_site=`` dirs.

    Parsing to VARIANT keeps every JSON type (string vs number) that the
    flatteners' truthiness rules need; an inferred schema would merge them.
    """
    reader = spark.readStream if stream else spark.read
    reader = (reader.option("singleVariantColumn", "page")
              .option("basePath", path))
    if stream:
        reader = reader.schema(
            "page variant, platform string, source_site string, order_month string")
    return reader.json(path)


def _sort_key(k: Column) -> list[Column]:
    """JavaScript's order of object keys: integer-like ones first, by number."""
    number = F.when(k.rlike("^(0|[1-9][0-9]{0,9})$"), k.cast("bigint"))
    return [number.isNull().alias("k0"), number.alias("k1"), k.alias("k2")]


def in_key_order(m: Column) -> Column:
    """Values of a map in JavaScript ``Object.values`` order (values that can be compared)."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(*_sort_key(e["key"]), e["value"].alias("v")))
    return F.transform(F.array_sort(entries), lambda e: e["v"])


def _values_in_key_order(v: Column) -> Column:
    """Values of a JSON object in JavaScript ``Object.values`` order.

    Integer-like keys come first in ascending numeric order; VARIANT stores
    keys sorted as text ("10" before "9"), so the keys are re-sorted here and
    the values, which cannot be compared, taken by position.
    """
    def sorted_values(m: Column) -> Column:
        keys = F.array_sort(F.transform(F.map_keys(m), lambda k, i: F.struct(*_sort_key(k), i.alias("i"))))
        return F.transform(keys, lambda k: F.get(F.map_values(m), k["i"]))
    # Bound as a lambda's variable: named in the inner lambda, the object is opened once per key.
    return F.get(F.transform(F.array(as_object(v)), sorted_values), F.lit(0))


def as_list(v: Column) -> Column:
    """array<variant> of an array value, or of an object's values (JS order)."""
    return F.when(is_object(v), _values_in_key_order(v)).otherwise(as_array(v))


def envelope_orders(platform: Column, page: Column, arr_page: Column | None = None,
                    orders: Column | None = None) -> Column:
    """array<variant> of the orders in one page, by the platform's rules.

    GoMag: ``orders`` (array, or id-keyed object) when truthy, else a bare
    array page.  MerchantPro: bare array, then ``data[]``, then ``orders[]``.
    WooCommerce: bare array.  Shopify: ``orders[]``.  Anything else: no orders.
    ``arr_page`` and ``orders``: the page as an array and its ``orders``, where they are columns.
    """
    arr_page = as_array(page) if arr_page is None else arr_page
    g_orders = F.variant_get(page, "$.orders", "variant") if orders is None else orders
    gomag = F.when(is_truthy(g_orders), F.coalesce(as_list(g_orders), F.array().cast(
        "array<variant>"))).otherwise(arr_page)
    mpro = F.coalesce(arr_page, as_array(F.variant_get(page, "$.data", "variant")),
                      as_array(F.variant_get(page, "$.orders", "variant")))
    shopify = F.coalesce(as_array(F.variant_get(page, "$.orders", "variant")), arr_page)
    empty = F.array().cast("array<variant>")
    return F.coalesce(F.when(platform == "gomag", gomag)
                      .when(platform == "merchantpro", mpro)
                      .when(platform == "shopify", shopify)
                      .otherwise(arr_page), empty)


def unwrap_envelope(pages: DataFrame) -> DataFrame:
    """(source_site, platform, raw) — one row per order; narrow (no shuffle)."""
    extra = [c for c in pages.columns if c not in ("source_site", "platform", "page")]
    staged = pages.select("source_site", "platform", "page", *extra,
                          as_array("page").alias("_arr"),
                          # A column, as each use of the expression builds all its orders anew.
                          F.when(F.col("platform") == "gomag", F.variant_get("page", "$.orders", "variant"))
                          .alias("_orders"))
    return staged.select("source_site", "platform", *extra, F.explode(envelope_orders(
        F.col("platform"), F.col("page"), F.col("_arr"), F.col("_orders"))).alias("raw"))


def read_raw_orders(spark: SparkSession, path: str) -> DataFrame:
    return unwrap_envelope(read_pages(spark, path))


def total_available(pages: DataFrame) -> DataFrame:
    """(source_site, platform, total_available) per site.

    GoMag/MerchantPro report a ``total`` in the envelope (parseInt of its text,
    0 when absent); MerchantPro falls back to the fetched count when it is 0.
    WooCommerce reports it in a header, which is not landed: fetched count.
    Partial aggregation keeps this a map-side combine per site.
    """
    total_txt = text_of(F.variant_get(F.col("page"), "$.total", "variant"), default="")
    reported = F.coalesce(F.regexp_extract(F.trim(total_txt), r"^([+-]?[0-9]+)", 1)
                          .try_cast("long"), F.lit(0))
    n = F.size(envelope_orders(F.col("platform"), F.col("page")))
    agg = (pages.groupBy("source_site", "platform")
           .agg(F.max(F.when(F.col("platform") != "woocommerce", reported)).alias("reported"),
                F.sum(n).cast("long").alias("fetched")))
    total = (F.when(F.col("platform") == "gomag", F.coalesce(F.col("reported"), F.lit(0)))
             .when(F.col("platform") == "merchantpro",
                   F.when(F.coalesce(F.col("reported"), F.lit(0)) != 0, F.col("reported"))
                   .otherwise(F.col("fetched")))
             .otherwise(F.col("fetched")))
    return agg.select("source_site", "platform", total.cast("long").alias("total_available"))
