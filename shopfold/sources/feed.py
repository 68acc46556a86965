"""Product feed source (S5) and a feed landing derived from the order data.

A feed is Google-Shopping style XML; only ``g:id`` elements are read, in whatever element they
lie: text or CDATA, tag name case-insensitive, trimmed, blanks dropped.  Spark's XML source reads
them with an explicit STRING schema (inference would turn ``007`` into 7) and splits files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.session import path_exists, scratch_path
from shopfold.sources.landing import site_of
from shopfold.sources.tables import read_table

FEED_SCHEMA = "`g:id` string"


def feed_rows(spark: SparkSession, sf_dir: str, sites: DataFrame) -> DataFrame:
    """(source_site, p_partkey) of every site's feed.

    A site's catalog is the distinct parts its orders reference, minus those
    with (p_partkey + site number) % 10 = 0, which are missing from the feed.
    Sites configured without a feed URL get no feed.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    with_site = li.join(o, li.l_orderkey == o.o_orderkey).select(
        site_of(F.col("o_orderkey")).alias("source_site"), F.col("l_partkey").alias("p_partkey"))
    has_feed = F.broadcast(sites.filter(F.col("product_feed_url").isNotNull())
                           .select(F.col("site_id").alias("source_site")))
    n = F.regexp_extract(F.col("source_site"), r"([0-9]+)$", 1).cast("long")
    return (with_site.join(has_feed, "source_site", "left_semi")
            .filter((F.col("p_partkey") + n) % 10 != 0).distinct())


# Ids per landed feed document: a document (one file) never exceeds this.
FEED_CHUNK = 5000
FEED_HEAD = '<rss version="2.0" xmlns:g="http://base.google.com/ns/1.0"><channel>'
FEED_TAIL = "</channel></rss>"


def feed_item_lines(feed: DataFrame) -> DataFrame:
    """(source_site, chunk, p_partkey, line): one ``<item>`` per id.

    Ids are written plain, padded, in CDATA or with upper-case tags, and
    blank and id-less items are added, so every rule of the reader is used.
    """
    pk = F.col("p_partkey")
    pid = pk.cast("string")
    gid = (F.when(pk % 7 == 0, F.concat(F.lit("<g:id><![CDATA[ "), pid, F.lit(" ]]></g:id>")))
           .when(pk % 11 == 0, F.concat(F.lit("<G:ID>"), pid, F.lit("</G:ID>")))
           .when(pk % 5 == 0, F.concat(F.lit("<g:id>  "), pid, F.lit("  </g:id>")))
           .otherwise(F.concat(F.lit("<g:id>"), pid, F.lit("</g:id>"))))
    item = F.concat(F.lit("<item>"), gid, F.lit("<g:price>1.00 RON</g:price></item>"))
    extra = (F.when(pk % 13 == 0, F.lit("<item><g:id>   </g:id></item>"))
             .when(pk % 17 == 0, F.lit("<item><title>no id</title></item>")))
    lines = F.filter(F.array(item, extra), lambda x: x.isNotNull())
    return feed.select("source_site", F.floor(pk / FEED_CHUNK).alias("chunk"), "p_partkey",
                       F.explode(lines).alias("line"))


def feed_container_lines(feed: DataFrame) -> DataFrame:
    """Like :func:`feed_item_lines`, with the ids in other elements than ``item``, in every
    spelling, with attributes, and beside ids in comments and CDATA that are none."""
    pk = F.col("p_partkey")
    letter = lambda k, low, up: F.when(F.floor(pk / k) % 2 == 0, F.lit(low)).otherwise(F.lit(up))
    tag = F.concat(letter(1, "g", "G"), F.lit(":"), letter(2, "i", "I"), letter(4, "d", "D"))
    attribute = F.when(pk % 9 == 0, F.lit(' type="sku"')).otherwise(F.lit(""))
    gid = F.concat(F.lit("<"), tag, attribute, F.lit("> "), pk.cast("string"), F.lit("</"), tag, F.lit(">"))
    around = lambda a, b: F.concat(F.lit(a), gid, F.lit(b))
    line = (F.when(pk % 5 == 0, around("<item>", "</item>")).when(pk % 5 == 1, around("<entry>", "</entry>"))
            .when(pk % 5 == 2, around("<product><details>", "</details></product>")).when(pk % 5 == 3, gid)
            .otherwise(around("<item><!-- <g:id>comment</g:id> --><title><![CDATA[<g:id>text</g:id>]]></title>",
                              "</item>")))
    return feed.select("source_site", F.floor(pk / FEED_CHUNK).alias("chunk"), "p_partkey", line.alias("line"))


def feed_documents(feed: DataFrame, lines=feed_item_lines) -> DataFrame:
    """(source_site, chunk, value): one complete XML document per id range.

    Grouping is by (site, id range), so a group holds at most FEED_CHUNK ids
    whatever the size or skew of a site's catalogue.
    """
    items = lines(feed)
    docs = items.groupBy("source_site", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", "line"))).alias("items"))
    body = F.array_join(F.transform("items", lambda x: x["line"]), "\n")
    return docs.select("source_site", "chunk",
                       F.concat(F.lit(FEED_HEAD + "\n"), body, F.lit("\n" + FEED_TAIL))
                       .alias("value"))


def land_feeds(spark: SparkSession, sf_dir: str, sites: DataFrame, name: str = "feeds",
               lines=feed_item_lines) -> str:
    """Write one XML file per (site, id range) under ``source_site=/chunk=``."""
    tag = sf_dir.rstrip("/").replace("/", "_").replace(".", "_").strip("_")
    path = scratch_path(spark, "landing", tag, name)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        (feed_documents(feed_rows(spark, sf_dir, sites), lines).repartition("source_site", "chunk")
         .write.mode("overwrite").partitionBy("source_site", "chunk").text(path))
    return path


def _spellings(spark: SparkSession, path: str) -> list[str]:
    """How the feeds under ``path`` spell the id tag (of eight possible ways): one scan of text."""
    found = spark.read.option("basePath", path).text(path).select(F.explode(F.regexp_extract_all(
        "value", F.lit("(?i)<(g:id)(?=[\\s>/]|$)"), F.lit(1))).alias("tag")).distinct().collect()
    return sorted(r["tag"] for r in found)


def read_feed_ids(spark: SparkSession, path: str) -> DataFrame:
    """(source_site, raw_id): the text of every ``g:id`` element, whatever holds it and however
    the tag is spelled.  Each spelling is a row tag of the XML source, which skips comments and
    CDATA sections and splits large files."""
    found = None
    for tag in _spellings(spark, path):
        one = (spark.read.format("xml").option("rowTag", tag).schema("_VALUE string")
               .option("basePath", path).load(path).select("source_site", F.col("_VALUE").alias("raw_id")))
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], "source_site string, raw_id string")


def read_feed_entries(spark: SparkSession, path: str) -> DataFrame:
    """(source_site, raw_id) — every ``item`` with its raw ``g:id`` text (or NULL)."""
    df = (spark.read.format("xml").option("rowTag", "item").schema(FEED_SCHEMA)
          .option("basePath", path).load(path))
    return df.select("source_site", F.col("`g:id`").alias("raw_id"))  # chunk is layout only


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """S5 + F7 + U2: distinct trimmed, non-blank ids per site."""
    e = read_feed_ids(spark, path)
    return (e.select("source_site", F.trim(F.col("raw_id")).alias("product_id"))
            .filter(F.col("product_id").isNotNull() & (F.col("product_id") != ""))
            .distinct())
