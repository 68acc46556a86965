"""Landed store data derived from the driver's TPC-H style tables.

The store APIs are not reachable, so their responses are re-created from
``orders`` + ``lineitem`` + ``part`` by a fixed recipe and landed as JSON text,
one API page per line, under ``platform=<p>/source_site=<s>/``.  Everything is
a Spark job: lines are grouped per order (bounded by the order's size), orders
are grouped per page (bounded by the page size), and the text is written by
the executors.

Recipe (all values are functions of the base rows, so an SQL oracle can
compute the expected flattened rows straight from the tables):

* platform = o_orderkey % 3 -> woocommerce / gomag / merchantpro;
  site = 'store_' || (o_orderkey % 6)
* items = lines joined to part, sorted by every line column
* status: F -> the platform's "done" word in upper case, O -> its cancelled
  word, P -> 'mystery' (unmapped)
* currency: omitted when o_custkey % 7 = 0, 'EUR' when o_custkey % 5 = 0,
  else 'RON'
* GoMag: l_returnflag = 'N' marks a service line; items form an id-keyed
  object for even order keys; the quantity key is `qty` on even line numbers
* MerchantPro: line subtotal only on odd line numbers (0 otherwise);
  `created_at` instead of `date_created` when o_orderkey % 4 = 3
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.schema import PAGE_SIZE
from shopfold.session import configure, path_exists, scratch_path, size_shuffles
from shopfold.sources.tables import read_table

PLATFORM_BY_MOD = ["woocommerce", "gomag", "merchantpro"]

# Status words per platform: (done, cancelled); unmapped orders get 'mystery'.
STATUS_WORDS = {
    "woocommerce": ("COMPLETED", "cancelled"),
    "gomag": ("FINALIZATA", "Anulata"),
    "merchantpro": ("DELIVERED", "cancelled"),
}
UNKNOWN_STATUS_WORD = "mystery"

LINE_SORT_COLS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def platform_of(orderkey: Column) -> Column:
    m = orderkey % 3
    return (F.when(m == 0, F.lit("woocommerce")).when(m == 1, F.lit("gomag"))
            .otherwise(F.lit("merchantpro")))


def site_of(orderkey: Column) -> Column:
    return F.concat(F.lit("store_"), (orderkey % 6).cast("string"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, lines) with lines sorted by every line column."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name",
                                                    "p_retailprice")
    # part is a dimension that grows with the data: no forced broadcast, AQE
    # turns the join into a broadcast only when the measured side is small.
    joined = li.join(part, li.l_partkey == part.p_partkey, "inner")
    line = F.struct(*[F.col(c) for c in LINE_SORT_COLS],
                    F.col("p_brand"), F.col("p_name"), F.col("p_retailprice"))
    # Grouped after the shuffle only: a collect_list before it would sort, and spill, whole splits.
    return (joined.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.array_sort(F.collect_list(line)).alias("lines")))


def _status_word(platform: Column, o_status: Column) -> Column:
    expr = None
    for p, (done, cancelled) in STATUS_WORDS.items():
        w = (F.when(o_status == "F", F.lit(done)).when(o_status == "O", F.lit(cancelled))
             .otherwise(F.lit(UNKNOWN_STATUS_WORD)))
        expr = F.when(platform == p, w) if expr is None else expr.when(platform == p, w)
    return expr


def _currency(custkey: Column) -> Column:
    return (F.when(custkey % 7 == 0, F.lit(None).cast("string"))
            .when(custkey % 5 == 0, F.lit("EUR")).otherwise(F.lit("RON")))


def _woo_doc() -> Column:
    items = F.transform("lines", lambda x: F.struct(
        x["l_partkey"].alias("product_id"),
        x["p_brand"].alias("sku"),
        x["p_name"].alias("name"),
        x["p_retailprice"].cast("string").alias("price"),
        x["l_quantity"].alias("quantity"),
        x["l_extendedprice"].cast("string").alias("total"),
    ))
    return F.to_json(F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("status_word").alias("status"),
        F.col("currency"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date_created"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.col("o_custkey").alias("customer_id"),
        F.struct(F.lit("RO").alias("country"), F.lit("Cluj").alias("city")).alias("billing"),
        F.lit("checkout").alias("created_via"),
        items.alias("line_items"),
    ))


def _gomag_item(x: Column) -> Column:
    odd_line = x["l_linenumber"] % 2 == 1
    return F.struct(
        x["l_partkey"].alias("id"),
        x["p_brand"].alias("sku"),
        x["p_name"].alias("name"),
        x["p_retailprice"].alias("price"),
        F.when(odd_line, x["l_quantity"]).alias("quantity"),
        F.when(~odd_line, x["l_quantity"]).alias("qty"),
        F.when(x["l_returnflag"] == "N", F.lit("service")).otherwise(F.lit("product"))
        .alias("type"),
    )


def _gomag_doc() -> Column:
    arr = F.transform("lines", _gomag_item)
    keyed = F.map_from_arrays(F.transform("lines", lambda x, i: (i + 1).cast("string")), arr)

    def doc(items: Column) -> Column:
        return F.to_json(F.struct(
            F.col("o_orderkey").alias("number"),
            F.concat(F.lit("G"), F.col("o_orderkey").cast("string")).alias("id"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
            F.col("status_word").alias("status"),
            F.lit(1).alias("statusId"),
            F.col("currency"),
            F.col("o_totalprice").alias("total"),
            F.struct(F.lit("GM").alias("series"), F.col("o_orderkey").alias("number"))
            .alias("invoice"),
            F.struct(F.lit("card").alias("name")).alias("payment"),
            F.struct(F.lit(15.0).alias("total"), F.lit("courier").alias("carrier"))
            .alias("delivery"),
            items.alias("items"),
        ))
    return F.when(F.col("o_orderkey") % 2 == 0, doc(keyed)).otherwise(doc(arr))


def _merchantpro_doc() -> Column:
    items = F.transform("lines", lambda x: F.struct(
        x["l_partkey"].alias("product_id"),
        x["p_brand"].alias("product_sku"),
        x["p_name"].alias("product_name"),
        x["p_retailprice"].alias("unit_price_gross"),
        x["l_quantity"].alias("quantity"),
        F.when(x["l_linenumber"] % 2 == 1, x["l_extendedprice"]).otherwise(F.lit(0.0))
        .alias("line_subtotal_gross"),
    ))
    alt_date = F.col("o_orderkey") % 4 == 3
    date_txt = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return F.to_json(F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(~alt_date, date_txt).alias("date_created"),
        F.when(alt_date, date_txt).alias("created_at"),
        F.col("status_word").alias("shipping_status"),
        F.lit("confirmed").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("currency"),
        items.alias("line_items"),
    ))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, platform, source_site, doc) — one raw order JSON text per order."""
    orders = read_table(spark, sf_dir, "orders")
    lines = order_lines(spark, sf_dir)
    base = (orders.join(lines, "o_orderkey", "left")
            .withColumn("lines", F.coalesce(F.col("lines"), F.array()))
            .withColumn("platform", platform_of(F.col("o_orderkey")))
            .withColumn("source_site", site_of(F.col("o_orderkey")))
            .withColumn("status_word", _status_word(F.col("platform"), F.col("o_orderstatus")))
            .withColumn("currency", _currency(F.col("o_custkey"))))
    doc = (F.when(F.col("platform") == "woocommerce", _woo_doc())
           .when(F.col("platform") == "gomag", _gomag_doc())
           .otherwise(_merchantpro_doc()))
    return base.select("o_orderkey", "platform", "source_site",
                       F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
                       doc.alias("doc"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_site, platform, raw VARIANT) straight from the tables (no landing)."""
    return order_documents(spark, sf_dir).select(
        "source_site", "platform", F.parse_json("doc").alias("raw"))


# Landed pages per file: a function of the page number, so a file is bounded however large a site is.
PAGES_PER_FILE = 50_000


def page_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(platform, source_site, order_month, page_no, page) — API pages as JSON text.

    Pages hold at most the platform's page size: the page number is a function
    of the order key, so no group ever exceeds it, whatever the skew of sites.
    The orders go to the task that writes their file, and are grouped there:
    their text is shuffled once.
    """
    docs = order_documents(spark, sf_dir)
    size = (F.when(F.col("platform") == "gomag", F.lit(PAGE_SIZE["gomag"]))
            .otherwise(F.lit(PAGE_SIZE["woocommerce"])))
    docs = docs.withColumn("page_no", F.floor(F.floor(F.col("o_orderkey") / 6) / size))
    # Site totals: one row per configured site, so the broadcast is bounded.
    totals = docs.groupBy("source_site").agg(F.count(F.lit(1)).alias("site_total"))
    files = ["platform", "source_site", "order_month", "file_no"]
    pages = (docs.withColumn("file_no", F.floor(F.col("page_no") / PAGES_PER_FILE)).repartition(*files)
             .groupBy(*files, "page_no")
             .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "doc"))).alias("docs"))
             .join(F.broadcast(totals), "source_site"))
    arr = F.concat(F.lit("["), F.array_join(F.transform("docs", lambda d: d["doc"]), ","),
                   F.lit("]"))
    obj = F.concat(F.lit("{"), F.array_join(F.transform("docs", lambda d: F.concat(
        F.lit('"'), d["o_orderkey"].cast("string"), F.lit('":'), d["doc"])), ","), F.lit("}"))
    even = F.col("page_no") % 2 == 0
    total_txt = F.col("site_total").cast("string")
    gomag = F.concat(F.lit('{"total":'),
                     F.when(even, total_txt).otherwise(F.concat(F.lit('"'), total_txt, F.lit('"'))),
                     F.lit(',"page":'), (F.col("page_no") + 1).cast("string"),
                     F.lit(',"orders":'), F.when(even, obj).otherwise(arr), F.lit("}"))
    mpro = F.when(even, F.concat(F.lit('{"data":'), arr, F.lit("}"))).otherwise(arr)
    page = (F.when(F.col("platform") == "gomag", gomag)
            .when(F.col("platform") == "merchantpro", mpro).otherwise(arr))
    return pages.select("platform", "source_site", "order_month", "page_no", page.alias("page"))


def landing_path(spark: SparkSession, sf_dir: str) -> str:
    tag = sf_dir.rstrip("/").replace("/", "_").replace(".", "_").strip("_")
    return scratch_path(spark, "landing", tag, "pages")


def land_pages(spark: SparkSession, sf_dir: str, path: str | None = None,
               overwrite: bool = False) -> str:
    """Write the API pages as JSON lines, partitioned by platform and site.

    Idempotent: an existing landing (committed, with _SUCCESS) is reused.  The
    write goes through Spark's file committer, so a lost executor only retries
    tasks and readers never see a half-written landing.
    """
    configure(spark)
    size_shuffles(spark, sf_dir)
    path = path or landing_path(spark, sf_dir)
    if not overwrite and path_exists(spark, f"{path}/_SUCCESS"):
        return path
    parts = ["platform", "source_site", "order_month"]
    (page_envelopes(spark, sf_dir).select(*parts, "page")
     .write.mode("overwrite").partitionBy(*parts).option("compression", "gzip").text(path))
    return path


# --- Shopify (documented platform without a connector in the original) -------

SHOPIFY_STATUS = {"F": "fulfilled", "P": "partially_fulfilled"}  # 'O' -> null (unfulfilled)


def shopify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order rendered as a Shopify Admin API order; sites 'shop_<key % 2>'.

    created_at carries a +02:00 offset, so the flattened order_date is UTC.
    """
    orders = read_table(spark, sf_dir, "orders")
    lines = order_lines(spark, sf_dir)
    base = (orders.join(lines, "o_orderkey", "left")
            .withColumn("lines", F.coalesce(F.col("lines"), F.array())))
    items = F.transform("lines", lambda x: F.struct(
        x["l_linenumber"].alias("id"),
        x["l_partkey"].alias("product_id"),
        x["p_brand"].alias("sku"),
        x["p_name"].alias("title"),
        x["p_retailprice"].cast("string").alias("price"),
        x["l_quantity"].cast("long").alias("quantity"),
    ))
    st = F.col("o_orderstatus")
    doc = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
        .alias("created_at"),
        F.lit("paid").alias("financial_status"),
        F.when(st == "F", F.lit(SHOPIFY_STATUS["F"])).when(st == "P", F.lit(SHOPIFY_STATUS["P"]))
        .alias("fulfillment_status"),
        F.col("o_totalprice").cast("string").alias("total_price"),
        _currency(F.col("o_custkey")).alias("currency"),
        items.alias("line_items"),
    ))
    return base.select(
        "o_orderkey", F.lit("shopify").alias("platform"),
        F.concat(F.lit("shop_"), (F.col("o_orderkey") % 2).cast("string")).alias("source_site"),
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"), doc.alias("doc"))


def land_shopify_pages(spark: SparkSession, sf_dir: str) -> str:
    """Pages ``{"orders": [...]}`` of at most 250 orders, laid out like the others."""
    configure(spark)
    size_shuffles(spark, sf_dir)
    tag = sf_dir.rstrip("/").replace("/", "_").replace(".", "_").strip("_")
    path = scratch_path(spark, "landing", tag, "shopify_pages")
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    docs = shopify_documents(spark, sf_dir).withColumn(
        "page_no", F.floor(F.floor(F.col("o_orderkey") / 2) / PAGE_SIZE["shopify"]))
    files = ["platform", "source_site", "order_month", "file_no"]
    pages = (docs.withColumn("file_no", F.floor(F.col("page_no") / PAGES_PER_FILE)).repartition(*files)
             .groupBy(*files, "page_no")
             .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "doc"))).alias("docs")))
    page = F.concat(F.lit('{"orders":['),
                    F.array_join(F.transform("docs", lambda d: d["doc"]), ","), F.lit("]}"))
    parts = ["platform", "source_site", "order_month"]
    (pages.select(*parts, page.alias("page"))
     .write.mode("overwrite").partitionBy(*parts).option("compression", "gzip").text(path))
    return path
