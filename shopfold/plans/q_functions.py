"""Registered queries: the scalar functions over table data."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopfold.functions.numeric import js_round2, line_total
from shopfold.functions.text import format_duration, relative_time, slugify, table_name_for
from shopfold.functions.text import truncate_sample
from shopfold.functions.values import parse_money, parse_qty, resolve_texts
from shopfold.operators.detect import apply_transform
from shopfold.plans.catalog import _out, register
from shopfold.sources.landing import platform_of
from shopfold.sources.tables import read_table

# The clock of the event-stream labels (end of the event data).
EVENTS_AS_OF = "2024-01-30 00:00:00"


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@register("first_truthy")
def q_first_truthy(spark, sf_dir):
    """``String(props.k || props.missing || 'none')`` over the event properties."""
    ev = _events(spark, sf_dir).select("event_id", F.try_parse_json("props").alias("p"))
    out = resolve_texts(ev, {"k_text": (["variant_get(p, '$.k', 'variant')",
                                         "variant_get(p, '$.missing', 'variant')"], "none")})
    return out.select("event_id", "k_text")


@register("to_text")
def q_to_text(spark, sf_dir):
    """``String(v)`` of JSON numbers (12.0 -> '12', 6.55 -> '6.55')."""
    ev = _events(spark, sf_dir).select(
        "event_id", F.parse_json(F.to_json(F.struct(F.col("value").alias("v")))).alias("p"))
    return ev.select("event_id", F.variant_get("p", "$.v", "string").alias("value_text"))


def _money_texts(spark, sf_dir):
    """Money texts in several shapes, built from the line prices by integer arithmetic."""
    li = read_table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    euros = F.floor(cents / 100).cast("long")
    c2 = F.lpad((cents % 100).cast("string"), 2, "0")
    kind = F.col("l_linenumber") % 5
    text = (F.when(kind == 0, F.concat(euros.cast("string"), F.lit("."), c2, F.lit(" lei")))
            .when(kind == 1, F.concat(F.floor(euros / 1000).cast("string"), F.lit("."),
                                      F.lpad((euros % 1000).cast("string"), 3, "0"), F.lit(","), c2))
            .when(kind == 2, F.concat(F.lit("--"), euros.cast("string")))
            .when(kind == 3, F.concat(euros.cast("string"), F.lit("e5")))
            .otherwise(F.concat(F.lit("RON -"), euros.cast("string"), F.lit(".5"))))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))


@register("parse_money")
def q_parse_money(spark, sf_dir):
    """Strip everything but digits, '.', '-', then parseFloat's prefix, || 0."""
    t = _money_texts(spark, sf_dir)
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "text",
                    parse_money(F.col("text")).alias("value"))


@register("parse_qty")
def q_parse_qty(spark, sf_dir):
    """parseFloat without stripping (' 2 kg' -> 2, '1,5' -> 1, '1e2' -> 100)."""
    li = read_table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long").cast("string")
    kind = F.col("l_linenumber") % 4
    text = (F.when(kind == 0, F.concat(F.lit(" "), q, F.lit(" kg")))
            .when(kind == 1, F.concat(q, F.lit(",5")))
            .when(kind == 2, F.concat(q, F.lit("e1")))
            .otherwise(F.concat(F.lit("x"), q)))
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "text",
                    parse_qty(F.col("text")).alias("value"))


@register("js_round2")
def q_js_round2(spark, sf_dir):
    """floor(x*100 + 0.5)/100 on discounted line prices."""
    li = read_table(spark, sf_dir, "lineitem")
    x = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     js_round2(x).alias("rounded"))


@register("line_total")
def q_line_total(spark, sf_dir):
    """Each platform's line-total rule on the order lines."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey)
    plat = platform_of(F.col("l_orderkey"))
    item_total = (F.when(plat == "woocommerce", F.col("l_extendedprice"))
                  .when(F.col("l_linenumber") % 2 == 1, F.col("l_extendedprice"))
                  .otherwise(F.lit(0.0)))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", plat.alias("platform"),
                    js_round2(line_total(plat, item_total, F.col("p_retailprice"),
                                         F.col("l_quantity"))).alias("product_total"))


@register("slugify")
def q_slugify(spark, sf_dir):
    """Site ids and table names from names (customer names here)."""
    c = read_table(spark, sf_dir, "customer")
    name = F.concat(F.col("c_name"), F.lit(" / "), F.col("c_mktsegment"))
    slug = slugify(name)
    return c.select("c_custkey", slug.alias("slug"), table_name_for(slug).alias("table_name"))


@register("format_duration")
def q_format_duration(spark, sf_dir):
    """Run durations of the derived history as labels."""
    from shopfold.sources.history import land_history, read_history
    h = read_history(spark, land_history(spark, sf_dir))
    d = F.col("duration_seconds") * 7
    return h.select("site_id", "started_at", format_duration(d).alias("label")).transform(_out)


@register("relative_time")
def q_relative_time(spark, sf_dir):
    """Event times relative to the end of the event data."""
    ev = _events(spark, sf_dir)
    return ev.select("event_id", relative_time(F.col("ts"), F.lit(EVENTS_AS_OF).cast("timestamp"))
                     .alias("label"))


@register("truncate_sample")
def q_truncate_sample(spark, sf_dir):
    """Preview cells of whole document texts (length is read over the whole text)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", truncate_sample(F.col("text")).alias("sample"))


@register("transforms")
def q_transforms(spark, sf_dir):
    """X11: toString / toNumber / toDate / split(',') on line values as text."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = li.join(part, li.l_partkey == part.p_partkey)
    num_txt = F.concat(F.lit(" "), F.col("l_quantity").cast("long").cast("string"), F.lit(" "))
    date_txt = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    parts = apply_transform(F.concat_ws(",", "p_brand", "p_type"), "split(',')")
    return _out(j.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        apply_transform(F.col("l_partkey").cast("string"), "toString").alias("as_string"),
        apply_transform(num_txt, "toNumber").alias("as_number"),
        apply_transform(date_txt, "toDate").alias("as_date"),
        F.size(parts).alias("n_parts"), F.element_at(parts, 1).alias("first_part")))

