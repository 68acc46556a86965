"""Run modes R1-R5: one plan for all sites of a run.

The reference syncs site after site; here every site of a run is one
DataFrame plan (sites are a column, not a loop), so a run is one scan of the
landed pages, one explode, one broadcast status join, one aggregation for the
dedup and one join for the merge.  :func:`run` gives the frames of a run;
:func:`run_into_table` carries it out on a table.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.operators.filters import (enabled_sites, hourly_sites, lookback_since,
                                        since_predicate, today_since)
from shopfold.operators.flatten import accepted, explode_items, order_headers, rejected
from shopfold.operators.merge import merge_status_only, merge_upsert
from shopfold.operators.status import normalize_status
from shopfold.operators.tables import ensure_table, merge_into_table
from shopfold.session import scratch_path

CONNECTORS = ("woocommerce", "gomag", "merchantpro")
MODES = ("full", "hourly", "status_only")


@dataclass
class RunFrames:
    rows: DataFrame        # flattened, windowed, status-normalised (incl. rejects)
    accepted: DataFrame
    rejects: DataFrame
    counts: DataFrame      # A3: rows per site, counted before dedup
    result: DataFrame      # the new target (affected sites only)


def run_sites(sites: DataFrame, mode: str, site_ids: list[str] | None = None) -> DataFrame:
    """Sites covered by a run (J6 is checked by :func:`check_site`)."""
    s = hourly_sites(sites) if mode == "hourly" else enabled_sites(sites)
    if site_ids is not None:
        s = s.filter(F.col("site_id").isin(*site_ids))
    return s


def windowed_rows(raw: DataFrame, sites: DataFrame, mappings: DataFrame, as_of,
                  mode: str, platforms: list[str] | None = None) -> DataFrame:
    """Per-site since window on order headers -> explode items -> status mapping.

    The window is applied to orders before the explode, so out-of-window
    orders are never expanded into item rows.
    """
    # Site settings: one row per configured site -> bounded broadcast.
    s = F.broadcast(sites.select(F.col("site_id").alias("source_site"), "lookback_days"))
    since = today_since(as_of) if mode == "hourly" else lookback_since(
        as_of, F.col("lookback_days"))
    headers = order_headers(raw.join(s, "source_site", "inner"), platforms)
    headers = headers.filter(since_predicate(since)).drop("lookback_days")
    # Status is order-level: map it before the explode (orders, not lines).
    return explode_items(normalize_status(headers, mappings), as_of, platforms)


def month_prune(sites: DataFrame, as_of, mode: str) -> F.Column:
    """Static partition filter on the landing's ``order_month`` per covered site.

    The site list is configuration (one row per site), so reading it on the
    driver is bounded; the resulting literal predicate prunes whole month
    directories at planning time.  Undated orders (NULL month) stay in.
    """
    as_of_ts = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(
        str(as_of))
    # One arm per lookback value; a day of slack, as a local date may lie a month before its UTC date.
    by_month: dict[str, list[str]] = {}
    for r in sites.select("site_id", "lookback_days").collect():
        if mode == "hourly":
            since = as_of_ts.replace(hour=0, minute=0, second=0, microsecond=0)
        else:
            since = as_of_ts - _dt.timedelta(days=r["lookback_days"] or 30)
        by_month.setdefault((since - _dt.timedelta(days=1)).strftime("%Y-%m"), []).append(r["site_id"])
    preds = None
    for month, ids in sorted(by_month.items()):
        p = F.col("source_site").isin(*ids) & ((F.col("order_month") >= month) | F.col("order_month").isNull())
        preds = p if preds is None else preds | p
    return preds if preds is not None else F.lit(False)


def run(raw: DataFrame, target: DataFrame, sites: DataFrame, mappings: DataFrame,
        as_of, mode: str = "full", site_ids: list[str] | None = None,
        platforms: list[str] | None = None) -> RunFrames:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    covered = run_sites(sites, mode, site_ids)
    site_list = F.broadcast(covered.select(F.col("site_id").alias("source_site")))
    raw_c = (raw.filter(month_prune(covered, as_of, mode)) if "order_month" in raw.columns
             else raw.join(site_list, "source_site", "left_semi"))
    rows = windowed_rows(raw_c, covered, mappings, as_of, mode, platforms)
    good = accepted(rows)
    tgt = target.join(site_list, "source_site", "left_semi")
    if mode == "status_only":
        result = merge_status_only(tgt, good)
    else:
        result = merge_upsert(tgt, good)
    counts = rows.groupBy("source_site").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("reject_count"))
    return RunFrames(rows, good, rejected(rows), counts, result)


def check_site(spark: SparkSession, sites: DataFrame, site_id: str) -> None:
    """An unknown or disabled site is an error, raised before any history."""
    hit = sites.filter(F.col("site_id") == site_id).select("enabled").limit(1).collect()
    if not hit:
        raise KeyError(f"Site not found: {site_id}")
    if not hit[0]["enabled"]:
        raise ValueError(f"Site is disabled: {site_id}")


def error_text(e: Exception) -> str:
    """The message of a failed job: Spark's error condition and its first sentence if there is
    one (the rest has task numbers and stack traces), else the first line."""
    named = re.search(r"\[([A-Z][A-Z0-9_.]+)\] ([^.\n]*)", str(e))
    return f"{named[1]}: {named[2]}" if named else str(e).strip().split("\n")[0]


def run_into_table(spark: SparkSession, name: str, raw: DataFrame, sites: DataFrame, mappings: DataFrame,
                   as_of: _dt.datetime, mode: str = "full", site_ids: list[str] | None = None,
                   completed_at: _dt.datetime | None = None, rejects: str | None = None) -> DataFrame:
    """A run that writes (R1-R5): check the named sites, make sure the table is there, stage the
    rows of the run once, merge them into the table, keep the refused rows, and return one result
    row per covered site (:func:`run_result_rows`).

    All sites go through one plan.  If that fails, each site is tried on its own: a failing site
    is recorded with its error and 0 rows, and the others are merged.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    for site_id in site_ids or []:
        check_site(spark, sites, site_id)
    ensure_table(spark, name)
    covered = run_sites(sites, mode, site_ids)
    # The site list is configuration: one row per site.
    todo = {r["site_id"]: r["platform"] for r in covered.select("site_id", "platform").collect()
            if r["platform"] in CONNECTORS}
    rejects = rejects or scratch_path(spark, "rejects", name, unique=True)
    counts: dict[str, tuple[int, int]] = {}
    errors: dict[str, str] = {}

    def sync(ids: list[str]) -> None:
        part = covered.filter(F.col("site_id").isin(*ids))
        rows = raw.filter(month_prune(part, as_of, mode)) if "order_month" in raw.columns else raw
        path = scratch_path(spark, "staging", unique=True)
        windowed_rows(rows, part, mappings, as_of, mode, sorted({todo[i] for i in ids})).write.parquet(path)
        staged = spark.read.parquet(path)
        merge_into_table(spark, name, accepted(staged), ids, status_only=mode == "status_only", stored=True)
        rejected(staged).write.mode("append").parquet(rejects)
        for r in staged.groupBy("source_site").agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col("reject_reason").isNotNull()).alias("bad")).collect():
            counts[r["source_site"]] = (r["n"], r["bad"])

    try:
        if todo:
            sync(sorted(todo))
    except Exception as all_sites:
        if len(todo) == 1:
            errors = {next(iter(todo)): error_text(all_sites)}
        else:
            for site_id in sorted(todo):
                try:
                    sync([site_id])
                except Exception as e:
                    errors[site_id] = error_text(e)
    counted = spark.createDataFrame([(k, *v) for k, v in counts.items()],
                                    "source_site string, row_count long, reject_count long")
    done = completed_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return run_result_rows(spark, counted, covered, as_of, done, mode, errors)


def run_result_rows(spark: SparkSession, counts: DataFrame, covered: DataFrame,
                    started_at: _dt.datetime, completed_at: _dt.datetime, mode: str,
                    errors: dict[str, str] | None = None) -> DataFrame:
    """One history/result row per covered site.

    ``duration_seconds = round(ms / 1000)``; an errored site reports 0 rows.
    Sites whose platform has no connector (Shopify) are recorded as errors.
    """
    errors = errors or {}
    err_df = spark.createDataFrame(list(errors.items()) or [("", "")],
                                   "site_id string, error string").filter(F.col("site_id") != "")
    dur_ms = int(round((completed_at - started_at).total_seconds() * 1000))
    dur = int((dur_ms + 500) // 1000)
    c = covered.select("site_id", "platform").join(
        counts.withColumnRenamed("source_site", "site_id"), "site_id", "left").join(
        F.broadcast(err_df), "site_id", "left")
    no_connector = F.col("platform") == "shopify"
    err = F.coalesce(F.col("error"), F.when(no_connector, F.lit("No connector for platform: shopify")))
    return c.select(
        "site_id",
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(completed_at).cast("timestamp").alias("completed_at"),
        F.lit(dur).cast("long").alias("duration_seconds"),
        F.when(err.isNull(), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.when(err.isNull(), F.coalesce(F.col("row_count"), F.lit(0))).otherwise(F.lit(0))
        .cast("long").alias("row_count"),
        F.lit(mode).alias("sync_type"),
        err.alias("error"),
    )
