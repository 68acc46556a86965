"""Helpers of the tests (a module of its own: `conftest` names several modules in one run)."""

SF_SMALL = "/root/testdata/sf0.001"


def raw_df(spark, docs):
    """(source_site, platform, raw) from (site, platform, json text) tuples."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(docs, "source_site string, platform string, doc string")
    return df.select("source_site", "platform", F.parse_json("doc").alias("raw"))
