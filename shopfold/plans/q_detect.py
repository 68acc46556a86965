"""Registered queries: feed, detection, mapping and preview."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shopfold.operators.detect import (apply_mapping, apply_transform, auto_map, detect_paths,
                                       nested_value, sample_text, suggest_columns)
from shopfold.operators.feed import feed_count, feed_membership, in_feed, not_in_feed
from shopfold.operators.flatten import explode_items, fact_columns, order_headers
from shopfold.plans import fixture as fx
from shopfold.plans.catalog import _flat, _out, register
from shopfold.sources.tables import read_table
from shopfold.sources.feed import feed_container_lines, land_feeds, read_feed, read_feed_entries

# Item array path per platform (where item-level mapping paths start).
ITEMS_PATH = {"woocommerce": "line_items", "gomag": "items", "merchantpro": "line_items"}

# Column mappings as a user would confirm them, per platform:
# (source path, target column, status, transform).
MAPPINGS = {
    "woocommerce": [
        ("id", "order_id", "confirmed", "toString"),
        ("date_created", "order_date", "confirmed", "toDate"),
        ("status", "order_status", "confirmed", "toString"),
        ("total", "order_total", "confirmed", "toNumber"),
        ("currency", "currency", "confirmed", None),
        ("line_items.product_id", "product_id", "confirmed", "toString"),
        ("line_items.sku", "product_sku", "confirmed", None),
        ("line_items.name", "product_name", "confirmed", None),
        ("line_items.price", "product_price", "confirmed", "toNumber"),
        ("line_items.quantity", "product_quantity", "confirmed", "toNumber"),
        ("line_items.total", "product_total", "confirmed", "toNumber"),
        ("customer_id", "", "ignored", None),
    ],
}


def _feed(spark, sf_dir):
    sites = fx.sites(spark, sf_dir)
    return read_feed(spark, land_feeds(spark, sf_dir, sites)), sites


@register("read_feed")
def q_read_feed(spark, sf_dir):
    """Distinct product ids of every site's feed."""
    feed, _ = _feed(spark, sf_dir)
    return feed


@register("read_feed_containers")
def q_read_feed_containers(spark, sf_dir):
    """The same ids from feeds that hold them in other elements and spellings."""
    path = land_feeds(spark, sf_dir, fx.sites(spark, sf_dir), "feeds_containers", feed_container_lines)
    return read_feed(spark, path)


@register("nonblank_ids")
def q_nonblank_ids(spark, sf_dir):
    """feed entries read vs. ids kept after trimming and dropping blanks."""
    sites = fx.sites(spark, sf_dir)
    e = read_feed_entries(spark, land_feeds(spark, sf_dir, sites))
    t = F.trim(F.col("raw_id"))
    return e.groupBy("source_site").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(t.isNotNull() & (t != "")).alias("kept_entries"))


@register("feed_count")
def q_feed_count(spark, sf_dir):
    feed, _ = _feed(spark, sf_dir)
    return feed_count(feed)


def _rows(spark, sf_dir):
    return fact_columns(_flat(spark, sf_dir)).select("source_site", "order_id", "product_id")


@register("feed_membership")
def q_feed_membership(spark, sf_dir):
    feed, sites = _feed(spark, sf_dir)
    return feed_membership(_rows(spark, sf_dir), feed, sites)


@register("in_feed")
def q_in_feed(spark, sf_dir):
    feed, _ = _feed(spark, sf_dir)
    return in_feed(_rows(spark, sf_dir), feed)


@register("not_in_feed")
def q_not_in_feed(spark, sf_dir):
    feed, sites = _feed(spark, sf_dir)
    return not_in_feed(_rows(spark, sf_dir), feed, sites)


@register("detect_columns")
def q_detect_columns(spark, sf_dir):
    """P6 + P7: cleaned leaf paths of all orders of every site."""
    return detect_paths(fx.raw(spark, sf_dir))


@register("clean_sample")
def q_clean_sample(spark, sf_dir):
    """The top-level keys that survive cleaning, per site."""
    from shopfold.functions.values import as_object
    from shopfold.operators.detect import clean_top_level
    top = fx.raw(spark, sf_dir).select("source_site", "platform", F.explode(
        as_object(F.col("raw"))).alias("path", "value"))
    return clean_top_level(top).select("source_site", "path").distinct()


@register("detect_columns_events")
def q_detect_columns_events(spark, sf_dir):
    """P7 on the event stream's JSON properties, per event type."""
    from shopfold.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source_site"), F.lit("events").alias("platform"),
        F.try_parse_json("props").alias("raw"))
    return detect_paths(ev, clean=False)


@register("auto_map")
def q_auto_map(spark, sf_dir):
    return auto_map(detect_paths(fx.raw(spark, sf_dir)))


@register("suggest_columns")
def q_suggest_columns(spark, sf_dir):
    """Suggestions by name similarity."""
    return suggest_columns(detect_paths(fx.raw(spark, sf_dir)))


@register("regex_transform")
def q_regex_transform(spark, sf_dir):
    """X11: custom patterns, with and without a group, on every part's texts."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        "p_partkey", apply_transform(F.col("p_brand"), r"regex:#?([0-9]+)$").alias("brand_number"),
        apply_transform(F.col("p_type"), "regex:[A-Z]+$").alias("last_word"),
        apply_transform(F.col("p_name"), "regex:([a-z]+) ([a-z]+)").alias("first_word"))


@register("nested_value")
def q_nested_value(spark, sf_dir):
    """P10 + X10: the preview cell of the product-id path of every order."""
    plats = fx.platforms(spark, sf_dir)
    h = order_headers(fx.raw(spark, sf_dir), plats)
    out = []
    for p, items in ITEMS_PATH.items():
        path = f"{items}.{'id' if p == 'gomag' else 'product_id'}"
        out.append(h.filter(F.col("platform") == p).select(
            "source_site", "order_id", F.lit(path).alias("path"),
            sample_text(nested_value(F.col("raw"), path)).alias("sample")))
    res = out[0]
    for x in out[1:]:
        res = res.unionByName(x)
    return res


@register("preview_mapping")
def q_preview_mapping(spark, sf_dir, n: int = 5):
    """The n newest orders of every site through the site's own flattener."""
    plats = fx.platforms(spark, sf_dir)
    h = order_headers(fx.raw(spark, sf_dir), plats)
    # A site has one platform; as a key it lets each platform's branch read its own files only.
    w = Window.partitionBy("source_site", "platform").orderBy(F.col("order_date").desc(),
                                                              F.col("order_id").asc())
    top = h.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    return _out(fact_columns(explode_items(top, fx.AS_OF, plats)))


@register("apply_mapping")
def q_apply_mapping(spark, sf_dir):
    """P9 + X11: a confirmed WooCommerce mapping applied with its transforms."""
    raw = fx.raw(spark, sf_dir, "woocommerce")
    return _out(apply_mapping(raw, MAPPINGS["woocommerce"], ITEMS_PATH["woocommerce"]))
