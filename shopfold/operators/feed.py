"""Feed membership (J4, J5) and feed counts (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feed_count(feed: DataFrame) -> DataFrame:
    """A4: distinct ids per site (the feed is already distinct)."""
    return feed.groupBy("source_site").agg(F.count(F.lit(1)).alias("product_count"))


def feed_membership(rows: DataFrame, feed: DataFrame, sites: DataFrame) -> DataFrame:
    """``in_feed`` true / false, or NULL when the site has no feed.

    The feed side grows with the catalogue, so it is a plain equi-join (AQE
    turns it into a broadcast only when the measured side is small).  The
    has-a-feed flag comes from the site configuration (bounded broadcast).
    """
    f = feed.select("source_site", "product_id", F.lit(True).alias("_hit"))
    has = F.broadcast(sites.select(F.col("site_id").alias("source_site"),
                                   F.col("product_feed_url").isNotNull().alias("_has_feed")))
    j = rows.join(f, ["source_site", "product_id"], "left").join(has, "source_site", "left")
    return j.withColumn("in_feed", F.when(F.coalesce(F.col("_has_feed"), F.lit(False)),
                                          F.coalesce(F.col("_hit"), F.lit(False)))
                        ).drop("_hit", "_has_feed")


def in_feed(rows: DataFrame, feed: DataFrame) -> DataFrame:
    """Rows whose product is in their site's feed (semi join)."""
    return rows.join(feed.select("source_site", "product_id"), ["source_site", "product_id"],
                     "left_semi")


def not_in_feed(rows: DataFrame, feed: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows of sites with a feed whose product is missing from it (anti join)."""
    has = F.broadcast(sites.filter(F.col("product_feed_url").isNotNull())
                      .select(F.col("site_id").alias("source_site")))
    return (rows.join(has, "source_site", "left_semi")
            .join(feed.select("source_site", "product_id"), ["source_site", "product_id"],
                  "left_anti"))
