"""Registered queries: sources, filters, sort/limit, sets, statuses (S1-S4, F*, L*, U*, A3-A6, J1, J3, J6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shopfold.operators.filters import enabled_sites, hourly_sites, lookback_since
from shopfold.operators.flatten import fact_columns, order_headers, raw_item_lists
from shopfold.operators.status import detect_status_map, detected_statuses, unmapped_summary
from shopfold.plans import fixture as fx
from shopfold.plans.catalog import _flat, _normalized, _out, merge_inputs, register
from shopfold.plans.sync import windowed_rows
from shopfold.schema import MATCH_KEYS
from shopfold.session import scratch_path
from shopfold.sources.raw import envelope_orders, total_available


@register("read_raw_orders")
def q_read_raw_orders(spark, sf_dir):
    """One row per landed order: its id text and its raw item count."""
    plats = fx.platforms(spark, sf_dir)
    h = raw_item_lists(order_headers(fx.raw(spark, sf_dir), plats), plats)
    return h.select("source_site", "platform", "order_id",
                    F.coalesce(F.size("_all_items"), F.lit(0)).cast("long").alias("n_items"))


@register("unwrap_envelope")
def q_unwrap_envelope(spark, sf_dir):
    """Pages and orders per site after unwrapping every envelope shape."""
    p = fx.pages(spark, sf_dir)
    n = F.size(envelope_orders(F.col("platform"), F.col("page")))
    return (p.groupBy("source_site", "platform")
            .agg(F.count(F.lit(1)).alias("n_pages"), F.sum(n).cast("long").alias("n_orders")))


@register("total_available")
def q_total_available(spark, sf_dir):
    return total_available(fx.pages(spark, sf_dir))


def _headers(spark, sf_dir):
    return order_headers(fx.raw(spark, sf_dir), fx.platforms(spark, sf_dir)).drop("raw")


@register("sample_orders")
def q_sample_orders(spark, sf_dir, n: int = 5):
    """The n newest orders of every site (date desc, then id)."""
    w = Window.partitionBy("source_site").orderBy(F.col("order_date").desc(),
                                                  F.col("order_id").asc())
    h = _headers(spark, sf_dir)
    return _out(h.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
                .select("source_site", "order_id", "order_date", "rn"))


@register("newest_orders")
def q_newest_orders(spark, sf_dir):
    """L1: every order, newest first (a range-partitioned global sort)."""
    h = _headers(spark, sf_dir)
    return _out(h.select("source_site", "order_id", "order_date")
                .orderBy(F.col("order_date").desc(), F.col("order_id").asc()))


@register("limit_n")
def q_limit_n(spark, sf_dir, n: int = 10):
    """L2: the n newest orders overall (TakeOrderedAndProject, no full sort)."""
    h = _headers(spark, sf_dir)
    return _out(h.select("source_site", "order_id", "order_date")
                .orderBy(F.col("order_date").desc(), F.col("order_id").asc()).limit(n))


def _all_sites_window(spark, sf_dir, platform=None):
    sites = fx.sites(spark, sf_dir)
    raw = fx.raw(spark, sf_dir, platform)
    return windowed_rows(raw, sites, fx.mappings(spark, sf_dir), fx.AS_OF, "full",
                         fx.platforms(spark, sf_dir, platform))


@register("since_filter")
def q_since_filter(spark, sf_dir):
    """rows of every site inside its own since window."""
    return _out(fact_columns(_all_sites_window(spark, sf_dir)))


@register("gomag_take_while")
def q_gomag_take_while(spark, sf_dir):
    """GoMag's newest-first read that stops at the first older order."""
    return _out(fact_columns(_all_sites_window(spark, sf_dir, "gomag")))


@register("lookback_window")
def q_lookback_window(spark, sf_dir):
    """per site, its since date and how many orders fall inside it."""
    sites = fx.sites(spark, sf_dir).select("site_id", "lookback_days")
    since = lookback_since(fx.AS_OF, F.col("lookback_days"))
    h = _headers(spark, sf_dir).select(F.col("source_site").alias("site_id"), "platform",
                                       "order_date")
    s = F.broadcast(sites.select("site_id", "lookback_days", since.alias("since")))
    j = h.join(s, "site_id")
    inside = F.when(F.col("platform") == "gomag", F.col("order_date") >= F.col("since")).otherwise(
        F.col("order_date") > F.col("since"))
    return _out(j.groupBy("site_id", "lookback_days", "since")
                .agg(F.count_if(inside).alias("orders_in_window")))


@register("today_window")
def q_today_window(spark, sf_dir):
    """the hourly run's rows (since midnight of the run day) of hourly sites."""
    sites = hourly_sites(fx.sites(spark, sf_dir))
    rows = windowed_rows(fx.raw(spark, sf_dir), sites, fx.mappings(spark, sf_dir), fx.AS_OF,
                         "hourly", fx.platforms(spark, sf_dir))
    return _out(fact_columns(rows))


@register("enabled_sites")
def q_enabled_sites(spark, sf_dir):
    return enabled_sites(fx.sites(spark, sf_dir)).select("site_id", "platform")


@register("hourly_sites")
def q_hourly_sites(spark, sf_dir):
    return hourly_sites(fx.sites(spark, sf_dir)).select("site_id", "platform")


@register("drop_service_items")
def q_drop_service_items(spark, sf_dir):
    """per GoMag order, kept and dropped (service) line items."""
    h = raw_item_lists(order_headers(fx.raw(spark, sf_dir, "gomag"), ["gomag"]), ["gomag"])
    total = F.coalesce(F.size("_all_items"), F.lit(0))
    kept = F.coalesce(F.size("_items"), F.lit(0))
    return h.select("source_site", "order_id", kept.cast("long").alias("kept_items"),
                    (total - kept).cast("long").alias("dropped_items"))


@register("run_row_count")
def q_run_row_count(spark, sf_dir):
    """A3: rows per site of a full run, counted before the dedup."""
    rows = _all_sites_window(spark, sf_dir)
    return rows.groupBy("source_site").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("reject_count"))


@register("distinct_statuses")
def q_distinct_statuses(spark, sf_dir):
    """A5: distinct non-empty raw statuses per site."""
    return detected_statuses(fx.raw(spark, sf_dir)).select("source_site", "raw_status")


@register("detect_status_map")
def q_detect_status_map(spark, sf_dir):
    """Detected statuses mapped through the platform defaults."""
    return detect_status_map(fx.raw(spark, sf_dir), spark)


@register("unmapped_statuses")
def q_unmapped_statuses(spark, sf_dir):
    """Rows per site and raw status left unmapped."""
    return unmapped_summary(_normalized(spark, sf_dir))


@register("unmapped_label")
def q_unmapped_label(spark, sf_dir):
    """The marked rows themselves."""
    rows = _normalized(spark, sf_dir)
    return rows.filter(F.col("order_status").startswith("[UNMAPPED] ")).select(
        "source_site", "order_id", "product_id", "order_status")


@register("merge_match")
def q_merge_match(spark, sf_dir):
    """Every target row with its match flag on the four keys (NULL never equal)."""
    target, source = merge_inputs(spark, sf_dir)
    s = source.select(*MATCH_KEYS).distinct().withColumn("matched", F.lit(True))
    return (target.select(*MATCH_KEYS).join(s, MATCH_KEYS, "left")
            .select(*MATCH_KEYS, F.coalesce(F.col("matched"), F.lit(False)).alias("matched")))


@register("site_lookup")
def q_site_lookup(spark, sf_dir):
    """Rows joined to their site's configuration (broadcast, bounded)."""
    rows = fact_columns(_flat(spark, sf_dir))
    sites = fx.sites(spark, sf_dir).select(F.col("site_id").alias("source_site"),
                                           F.col("name").alias("site_name"), "platform",
                                           "table_name", "enabled")
    return rows.join(F.broadcast(sites), "source_site").select(
        "source_site", "order_id", "product_id", "site_name", "platform", "table_name",
        "enabled")


@register("union_sites")
def q_union_sites(spark, sf_dir):
    """Per-platform flattens unioned by name."""
    parts = [fact_columns(_flat(spark, sf_dir, p))
             for p in ("woocommerce", "gomag", "merchantpro")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _out(out)


@register("distinct_ids")
def q_distinct_ids(spark, sf_dir):
    """The set of product ids per site."""
    rows = _flat(spark, sf_dir)
    return (rows.filter(F.col("product_id") != "").select("source_site", "product_id")
            .distinct())



@register("read_sites")
def q_read_sites(spark, sf_dir):
    """The site list with each site's effective status mapping (defaults filled in)."""
    s = fx.sites(spark, sf_dir).select("site_id", "name", "platform", "table_name",
                                       "lookback_days", "hourly_sync_enabled", "enabled",
                                       F.col("product_feed_url").isNotNull().alias("has_feed"))
    return s.join(fx.mappings(spark, sf_dir), "site_id")


def _sites_json(spark, sf_dir):
    """The site list written as JSON (own status lists only) and read back."""
    from shopfold.plans.q_detect import MAPPINGS
    from shopfold.sources.sites import SITE_STATUS_OVERRIDES, read_sites_json, write_sites_json
    status = "array<struct<sourceStatus:string,targetStatus:string>>"
    column = "array<struct<sourceColumn:string,targetColumn:string,status:string,transform:string>>"
    own = F.array().cast(status)
    for site, listed in SITE_STATUS_OVERRIDES.items():
        own = F.when(F.col("site_id") == site, F.array(*[
            F.struct(F.lit(a).alias("sourceStatus"), F.lit(b).alias("targetStatus")) for a, b in listed])).otherwise(own)
    columns = F.lit(None).cast(column)
    for platform, listed in MAPPINGS.items():
        columns = F.when(F.col("platform") == platform, F.array(*[F.struct(*[
            F.lit(v).cast("string").alias(n) for n, v in zip(("sourceColumn", "targetColumn", "status", "transform"), m)])
            for m in listed])).otherwise(columns)
    path = scratch_path(spark, "sites_json", unique=True)
    write_sites_json(fx.sites(spark, sf_dir).withColumn("status_mapping", own.cast(status))
                     .withColumn("column_mapping", columns.cast(column)), path)
    return read_sites_json(spark, path)


@register("read_sites_json")
def q_read_sites_json(spark, sf_dir):
    """The JSON site list with the effective status mapping."""
    from shopfold.sources.sites import status_mapping_rows
    sites = _sites_json(spark, sf_dir)
    rows = sites.select("site_id", "name", "platform", "table_name", "lookback_days", "hourly_sync_enabled",
                        "enabled", F.col("product_feed_url").isNotNull().alias("has_feed"),
                        F.size("column_mapping").cast("long").alias("n_columns"))
    return rows.join(status_mapping_rows(sites), "site_id")


@register("json_mappings_applied")
def q_json_mappings_applied(spark, sf_dir):
    """S6 + P9: the column mappings of the JSON site list, applied to the sites' orders."""
    from shopfold.operators.detect import apply_mapping
    from shopfold.plans.q_detect import ITEMS_PATH
    from shopfold.sources.sites import column_mapping_rows
    sites = _sites_json(spark, sf_dir).filter("platform = 'woocommerce'")
    # Mappings are configuration: a handful of rows per site.
    rows = column_mapping_rows(sites).orderBy("site_id", "pos").collect()
    by_mapping: dict[tuple, list[str]] = {}
    for site in sorted({r["site_id"] for r in rows}):
        mapping = tuple((r["source_column"], r["target_column"], r["status"], r["transform"])
                        for r in rows if r["site_id"] == site)
        by_mapping.setdefault(mapping, []).append(site)
    raw, out = fx.raw(spark, sf_dir, "woocommerce"), None
    for mapping, ids in by_mapping.items():
        one = apply_mapping(raw.filter(F.col("source_site").isin(*ids)), list(mapping), ITEMS_PATH["woocommerce"])
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return _out(out)
