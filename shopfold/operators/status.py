"""Status normalisation and detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.functions.text import unmapped_label
from shopfold.functions.values import first_truthy, vtype
from shopfold.schema import DEFAULT_STATUS_MAPPINGS, DETECT_FALLBACK_STATUS, UNMAPPED_PREFIX


def default_mappings(spark: SparkSession) -> DataFrame:
    """(platform, pos, source_status, target_status) of the platform defaults."""
    rows = [(p, i, s, t) for p, lst in DEFAULT_STATUS_MAPPINGS.items()
            for i, (s, t) in enumerate(lst)]
    return spark.createDataFrame(
        rows, "platform string, pos int, source_status string, target_status string")


def lookup_table(mappings: DataFrame) -> DataFrame:
    """(site_id, status_key, target_status): case-folded, first entry wins.

    The mapping list is configuration (sites x entries), so it is small and
    bounded; the min-by-position pick happens before the broadcast.
    """
    return (mappings.groupBy("site_id", F.lower("source_status").alias("status_key"))
            .agg(F.min_by("target_status", "pos").alias("target_status")))


def normalize_status(rows: DataFrame, mappings: DataFrame) -> DataFrame:
    """order_status -> mapped target, else '[UNMAPPED] ' + raw.

    Case-insensitive (``lower`` on both sides), no trimming.  The lookup is a
    broadcast hash join: the probe side (the rows) is never shuffled.
    """
    lk = lookup_table(mappings).withColumnRenamed("site_id", "_site")
    joined = rows.join(
        F.broadcast(lk),
        (rows["source_site"] == lk["_site"]) & (F.lower(rows["order_status"]) == lk["status_key"]),
        "left")
    mapped = F.coalesce(F.col("target_status"), unmapped_label(F.col("order_status")))
    return (joined.withColumn("order_status", mapped)
            .drop("_site", "status_key", "target_status"))


def detected_statuses(raw: DataFrame, platform_rule: bool = True) -> DataFrame:
    """A5: distinct non-empty raw statuses per site.

    The detection reads ``status ?? order_status`` and keeps only JSON strings.
    MerchantPro's flattener prefers ``shipping_status``; with ``platform_rule``
    we follow the flattener for it so detection matches what sync maps.
    """
    v1 = F.variant_get(F.col("raw"), "$.status", "variant")
    v2 = F.variant_get(F.col("raw"), "$.order_status", "variant")
    nullish = v1.isNull() | F.is_variant_null(v1)
    chosen = F.when(nullish, v2).otherwise(v1)
    if platform_rule:
        ship = F.variant_get(F.col("raw"), "$.shipping_status", "variant")
        chosen = F.when(F.col("platform") == "merchantpro", first_truthy(ship, v1)).otherwise(
            chosen)
    status = F.when(vtype(chosen) == "STRING", F.variant_get(chosen, "$", "string"))
    return (raw.select("source_site", "platform", status.alias("raw_status"))
            .filter(F.col("raw_status").isNotNull() & (F.col("raw_status") != ""))
            .distinct())


def detect_status_map(raw: DataFrame, spark: SparkSession) -> DataFrame:
    """Detected statuses left-joined to the platform defaults.

    A hit returns the default's own spelling and target; a miss maps to
    'order_processed'.
    """
    st = detected_statuses(raw)
    d = default_mappings(spark)
    dl = (d.groupBy("platform", F.lower("source_status").alias("k"))
          .agg(F.min_by(F.struct("source_status", "target_status"), "pos").alias("d")))
    j = st.join(F.broadcast(dl), (st["platform"] == dl["platform"])
                & (F.lower(st["raw_status"]) == dl["k"]), "left")
    return j.select(
        st["source_site"], st["raw_status"],
        F.coalesce(F.col("d.source_status"), st["raw_status"]).alias("source_status"),
        F.coalesce(F.col("d.target_status"), F.lit(DETECT_FALLBACK_STATUS)).alias("target_status"))


def unmapped_summary(rows: DataFrame) -> DataFrame:
    """Per site and raw status, how many rows stayed unmapped."""
    prefix_len = len(UNMAPPED_PREFIX)
    return (rows.filter(F.col("order_status").startswith(UNMAPPED_PREFIX))
            .groupBy("source_site",
                     F.expr(f"substring(order_status, {prefix_len + 1})").alias("raw_status"))
            .agg(F.count(F.lit(1)).alias("row_count")))

