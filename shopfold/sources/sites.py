"""Site dimension (S6) and mapping configuration.

A site list is configuration; here it is derived from the landed data (one
site per distinct ``source_site`` of the orders) plus per-site settings given
by rule, so its size follows the data's site count.  Credentials are never
carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.functions.text import slugify, table_name_for
from shopfold.schema import DEFAULT_STATUS_MAPPINGS, DEFAULT_SYNC_SCHEDULE, LOOKBACK_OPTIONS
from shopfold.sources.landing import platform_of
from shopfold.sources.tables import read_table

# Custom status lists per site (an empty or absent list means: platform defaults).
# store_0 maps one status twice; the first entry must win.
SITE_STATUS_OVERRIDES = {
    "store_0": [
        ("completed", "order_processed"),
        ("COMPLETED", "order_cancelled"),
        ("cancelled", "order_cancelled"),
    ],
}
# Sites configured without a product feed, and disabled sites.
SITES_WITHOUT_FEED = ["store_3"]
DISABLED_SITES = ["store_5"]


def _site_no(site_id: Column) -> Column:
    return F.regexp_extract(site_id, r"([0-9]+)$", 1).cast("int")


def sites_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site rows for every ``source_site`` present in ``orders``."""
    orders = read_table(spark, sf_dir, "orders")
    ids = orders.select((F.col("o_orderkey") % 6).alias("n")).distinct()
    return site_rows(ids.select(F.concat(F.lit("store_"), F.col("n").cast("string"))
                                .alias("site_id"),
                                platform_of(F.col("n")).alias("platform")))


def site_rows(ids: DataFrame) -> DataFrame:
    """Fill the site settings by rule from (site_id, platform)."""
    n = _site_no(F.col("site_id"))
    name = F.concat(F.lit("Store "), n.cast("string"), F.lit(" "),
                    F.initcap(F.col("platform")))
    lookback = F.element_at(F.array(*[F.lit(x) for x in LOOKBACK_OPTIONS]),
                            (n % len(LOOKBACK_OPTIONS)) + 1)
    return ids.select(
        F.col("site_id"),
        name.alias("name"),
        F.col("platform"),
        table_name_for(F.regexp_replace(F.col("site_id"), "_", "-")).alias("table_name"),
        F.when(~F.col("site_id").isin(*SITES_WITHOUT_FEED),
               F.concat(F.lit("feeds/"), F.col("site_id"), F.lit(".xml"))).alias(
            "product_feed_url"),
        F.lit(DEFAULT_SYNC_SCHEDULE).alias("sync_schedule"),
        lookback.cast("int").alias("lookback_days"),
        (n % 2 == 0).alias("hourly_sync_enabled"),
        F.lit(None).cast("timestamp").alias("last_sync_at"),
        F.lit(None).cast("string").alias("last_sync_status"),
        F.lit(None).cast("long").alias("last_sync_row_count"),
        (~F.col("site_id").isin(*DISABLED_SITES)).alias("enabled"),
    )


def status_mappings(spark: SparkSession, sites: DataFrame) -> DataFrame:
    """(site_id, pos, source_status, target_status) with the defaults filled in.

    A site whose own list is empty gets its platform's default list.
    """
    custom_rows = [(s, i, a, b) for s, lst in SITE_STATUS_OVERRIDES.items()
                   for i, (a, b) in enumerate(lst)]
    custom = spark.createDataFrame(
        custom_rows, "site_id string, pos int, source_status string, target_status string")
    default_rows = [(p, i, a, b) for p, lst in DEFAULT_STATUS_MAPPINGS.items()
                    for i, (a, b) in enumerate(lst)]
    defaults = spark.createDataFrame(
        default_rows, "platform string, pos int, source_status string, target_status string")
    s = sites.select("site_id", "platform")
    has_custom = s.join(custom.select("site_id").distinct(), "site_id", "left_semi")
    no_custom = s.join(custom.select("site_id").distinct(), "site_id", "left_anti")
    return (has_custom.join(custom, "site_id").select("site_id", "pos", "source_status",
                                                      "target_status")
            .unionByName(no_custom.join(defaults, "platform")
                         .select("site_id", "pos", "source_status", "target_status")))


# --- the site list as JSON ------------------------------------------------------

#: The JSON site list; credentials are left out of the schema, so they are never read.
SITES_JSON_SCHEMA = (
    "id string, name string, platform string, bigqueryTable string, "
    "columnMapping array<struct<sourceColumn:string,targetColumn:string,status:string,transform:string>>, "
    "statusMapping array<struct<sourceStatus:string,targetStatus:string>>, productFeedUrl string, "
    "syncSchedule string, lookbackDays int, hourlySyncEnabled boolean, lastSyncAt timestamp, "
    "lastSyncStatus string, lastSyncRowCount long, enabled boolean")


def read_sites_json(spark: SparkSession, path: str) -> DataFrame:
    """The JSON site list (an array of objects, or one object a line), one row per site.

    Columns are those of :func:`site_rows`, and ``column_mapping`` and ``status_mapping`` as
    arrays.  A missing or empty status mapping is filled with the platform's default list; an
    unknown platform has none.
    """
    raw = spark.read.schema(SITES_JSON_SCHEMA).option("multiLine", True).json(path)
    entry = "array<struct<sourceStatus:string,targetStatus:string>>"
    defaults = F.create_map(*[x for platform, listed in DEFAULT_STATUS_MAPPINGS.items() for x in (
        F.lit(platform), F.array(*[F.struct(F.lit(a).alias("sourceStatus"), F.lit(b).alias("targetStatus"))
                                   for a, b in listed]))])
    own = F.when(F.size("statusMapping") > 0, F.col("statusMapping"))
    filled = F.coalesce(own, F.try_element_at(defaults, F.col("platform")), F.array().cast(entry))
    return raw.select(
        F.col("id").alias("site_id"), "name", "platform", F.col("bigqueryTable").alias("table_name"),
        F.col("productFeedUrl").alias("product_feed_url"), F.col("syncSchedule").alias("sync_schedule"),
        F.col("lookbackDays").alias("lookback_days"),
        F.coalesce("hourlySyncEnabled", F.lit(False)).alias("hourly_sync_enabled"),
        F.col("lastSyncAt").alias("last_sync_at"), F.col("lastSyncStatus").alias("last_sync_status"),
        F.col("lastSyncRowCount").alias("last_sync_row_count"),
        F.coalesce("enabled", F.lit(False)).alias("enabled"),
        F.coalesce("columnMapping", F.array()).alias("column_mapping"), filled.alias("status_mapping"))


def status_mapping_rows(sites: DataFrame) -> DataFrame:
    """(site_id, pos, source_status, target_status) of a site list with ``status_mapping``."""
    return sites.select("site_id", F.posexplode("status_mapping").alias("pos", "m")).select(
        "site_id", "pos", F.col("m.sourceStatus").alias("source_status"),
        F.col("m.targetStatus").alias("target_status"))


def column_mapping_rows(sites: DataFrame) -> DataFrame:
    """(site_id, pos, source_column, target_column, status, transform) of a site list."""
    return sites.select("site_id", F.posexplode("column_mapping").alias("pos", "m")).select(
        "site_id", "pos", F.col("m.sourceColumn").alias("source_column"),
        F.col("m.targetColumn").alias("target_column"), F.col("m.status").alias("status"),
        F.col("m.transform").alias("transform"))


def write_sites_json(sites: DataFrame, path: str) -> None:
    """The site list as a JSON array, with each site's own mappings (one row per configured site)."""
    renamed = sites.select(F.struct(
        F.col("site_id").alias("id"), "name", "platform", F.col("table_name").alias("bigqueryTable"),
        F.col("column_mapping").alias("columnMapping"), F.col("status_mapping").alias("statusMapping"),
        F.col("product_feed_url").alias("productFeedUrl"), F.col("sync_schedule").alias("syncSchedule"),
        F.col("lookback_days").alias("lookbackDays"), F.col("hourly_sync_enabled").alias("hourlySyncEnabled"),
        F.col("last_sync_at").alias("lastSyncAt"), F.col("last_sync_status").alias("lastSyncStatus"),
        F.col("last_sync_row_count").alias("lastSyncRowCount"), "enabled").alias("s"))
    (renamed.agg(F.to_json(F.sort_array(F.collect_list("s"))).alias("value"))
     .write.mode("error").text(path))


def site_slug(name: Column) -> Column:
    return slugify(name)
