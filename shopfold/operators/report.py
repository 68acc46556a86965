"""Site marks after a run, status rows and the daily report data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.schema import REPORT_TIME_ZONE


def mark_sites(sites: DataFrame, results: DataFrame) -> DataFrame:
    """Apply a full run's results to the site rows.

    Success: last_sync_at = run start, status and row count set.  Error: only
    the status changes.  Sites outside the run keep their marks.  The results
    have one row per site, so the join is a bounded broadcast.
    """
    r = F.broadcast(results.select("site_id", F.col("started_at").alias("_at"),
                                   F.col("status").alias("_st"),
                                   F.col("row_count").alias("_rc")))
    j = sites.join(r, "site_id", "left")
    ok = F.col("_st") == "success"
    return j.select(
        *[c for c in sites.columns if c not in ("last_sync_at", "last_sync_status",
                                                "last_sync_row_count")],
        F.when(ok, F.col("_at")).otherwise(F.col("last_sync_at")).alias("last_sync_at"),
        F.coalesce(F.col("_st"), F.col("last_sync_status")).alias("last_sync_status"),
        F.when(ok, F.col("_rc")).otherwise(F.col("last_sync_row_count"))
        .alias("last_sync_row_count"),
    ).select(*sites.columns)


def sync_status(sites: DataFrame) -> DataFrame:
    """Status rows with the defaults 'idle', NULL and 0."""
    return sites.select(
        "site_id", "name", "platform",
        F.coalesce(F.col("last_sync_status"), F.lit("idle")).alias("status"),
        F.col("last_sync_at"),
        F.coalesce(F.col("last_sync_row_count"), F.lit(0)).cast("long").alias(
            "last_sync_row_count"),
        "enabled")


def status_label(status) -> F.Column:
    return (F.when(status == "success", F.lit("Success"))
            .when(status == "error", F.lit("Error"))
            .when(status == "running", F.lit("Running"))
            .otherwise(F.lit("Never synced")))


def site_report(sites: DataFrame) -> DataFrame:
    """A2: one report line per site; last sync shown in the report's time zone."""
    local = F.from_utc_timestamp(F.col("last_sync_at"), REPORT_TIME_ZONE)
    return sites.select(
        "name", "platform",
        status_label(F.col("last_sync_status")).alias("label"),
        F.coalesce(F.col("last_sync_row_count"), F.lit(0)).cast("long").alias("rows"),
        F.when(F.col("last_sync_at").isNull(), F.lit("Never"))
        .otherwise(F.date_format(local, "dd.MM.yyyy, HH:mm:ss")).alias("last_sync"))


def report_totals(sites: DataFrame) -> DataFrame:
    """A1: total rows (NULL as 0), successes, errors and sites."""
    return sites.agg(
        F.coalesce(F.sum(F.coalesce(F.col("last_sync_row_count"), F.lit(0))), F.lit(0))
        .cast("long").alias("total_rows"),
        F.count_if(F.col("last_sync_status") == "success").alias("success_count"),
        F.count_if(F.col("last_sync_status") == "error").alias("error_count"),
        F.count(F.lit(1)).alias("site_count"))


def dashboard_summary(sites: DataFrame) -> DataFrame:
    """Sites, active sites, sites in error, last run."""
    return sites.agg(
        F.count(F.lit(1)).alias("sites"),
        F.count_if(F.col("enabled")).alias("active"),
        F.count_if(F.col("last_sync_status") == "error").alias("errors"),
        F.max("last_sync_at").alias("last_sync_at"))
