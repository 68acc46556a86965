"""Registered queries: run modes, history and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shopfold.operators.flatten import fact_columns
from shopfold.operators.history import (newest_per_site, retain, store_history,
                                         stored_history)
from shopfold.operators.report import (dashboard_summary, mark_sites, report_totals,
                                       site_report, sync_status)
from shopfold.operators.tables import append_rows, ensure_table, read_sites_of
from shopfold.plans import fixture as fx
from shopfold.plans.catalog import _flat, _out, register
from shopfold.plans.sync import run, run_into_table, run_result_rows, run_sites
from shopfold.schema import HISTORY_LIMIT_ALL_SITES, HISTORY_LIMIT_ONE_SITE, STANDARD_COLUMNS
from shopfold.session import scratch_path
from shopfold.sources.history import land_history, read_history


def run_target(spark, sf_dir):
    """The table before the run (an earlier run, statuses not yet updated),
    stored partitioned by site so a run reads only its sites' partitions."""
    def build():
        return (fact_columns(_flat(spark, sf_dir, as_of=fx.TARGET_SYNCED_AT))
                .filter((F.col("order_date") >= F.lit(fx.RUN_TARGET_START))
                        & (F.col("order_date") < F.lit(fx.RUN_TARGET_END)))
                .withColumn("order_status", F.lit(fx.TARGET_STATUS)))
    t = fx.materialized(spark, sf_dir, "run_target", build, ["source_site"])
    return t.select(*STANDARD_COLUMNS)


def _run(spark, sf_dir, mode, site_ids=None):
    sites = fx.sites(spark, sf_dir)
    frames = run(fx.raw(spark, sf_dir), run_target(spark, sf_dir), sites,
                 fx.mappings(spark, sf_dir), fx.AS_OF, mode, site_ids,
                 fx.platforms(spark, sf_dir))
    return sites, frames


def _run_table(spark, sf_dir, mode, site_ids=None, raw=None, sites=None):
    """A table holding the earlier run, the run carried out on it, and its result rows."""
    sites = fx.sites(spark, sf_dir) if sites is None else sites
    name = f"run_{uuid.uuid4().hex[:12]}"
    ensure_table(spark, name)
    append_rows(spark, name, run_target(spark, sf_dir))
    results = run_into_table(spark, name, fx.raw(spark, sf_dir) if raw is None else raw, sites,
                             fx.mappings(spark, sf_dir), fx.AS_OF, mode, site_ids,
                             fx.AS_OF + fx.RUN_TIME)
    # The covered sites' rows, read back (one row per site in the list).
    covered = [r["site_id"] for r in run_sites(sites, mode, site_ids).select("site_id").collect()]
    return read_sites_of(spark, name, covered), results


@register("sync_full")
def q_sync_full(spark, sf_dir):
    """One site's full run merged into the table; its part of the table read back."""
    return _out(_run_table(spark, sf_dir, "full", [fx.RUN_SITE])[0])


@register("sync_hourly")
def q_sync_hourly(spark, sf_dir):
    """R2: hourly sites, today's orders, full upsert into the table."""
    return _out(_run_table(spark, sf_dir, "hourly")[0])


@register("sync_status_only")
def q_sync_status_only(spark, sf_dir):
    """Enabled sites, lookback window, status-only merge into the table."""
    return _out(_run_table(spark, sf_dir, "status_only")[0])


@register("sync_all")
def q_sync_all(spark, sf_dir):
    """Every enabled site in one plan, merged into the table."""
    return _out(_run_table(spark, sf_dir, "full")[0])


def _results(spark, sf_dir, mode="full"):
    sites, f = _run(spark, sf_dir, mode)
    covered = run_sites(sites, mode)
    return sites, run_result_rows(spark, f.counts, covered, fx.AS_OF, fx.AS_OF, mode)


@register("run_result")
def q_run_result(spark, sf_dir):
    """R4 + R5: the result rows of a full run in which one site's source fails and one site's
    platform has no connector; the other sites are merged."""
    sites = fx.sites(spark, sf_dir)
    shop = sites.limit(1).select(*[
        F.lit({"site_id": fx.NO_CONNECTOR_SITE, "platform": "shopify"}[c]).alias(c)
        if c in ("site_id", "platform") else F.lit(True).alias(c) if c == "enabled" else F.col(c)
        for c in sites.columns])
    raw = fx.raw(spark, sf_dir)
    raw = raw.withColumn("raw", F.expr(
        f"CASE WHEN source_site = '{fx.FAILING_SITE}' "
        "THEN parse_json(CAST(CAST(concat('not a page of ', source_site) AS INT) AS STRING)) ELSE raw END"))
    results = _run_table(spark, sf_dir, "full", None, raw, sites.unionByName(shop))[1]
    return _out(results.withColumn("error", F.substring_index("error", ":", 1)))


def _marked_sites(spark, sf_dir):
    sites, res = _results(spark, sf_dir)
    return mark_sites(sites, res)


@register("sync_status")
def q_sync_status(spark, sf_dir):
    return _out(sync_status(_marked_sites(spark, sf_dir)))


@register("report_totals")
def q_report_totals(spark, sf_dir):
    return report_totals(_marked_sites(spark, sf_dir))


@register("site_report")
def q_site_report(spark, sf_dir):
    return site_report(_marked_sites(spark, sf_dir))


@register("dashboard_summary")
def q_dashboard_summary(spark, sf_dir):
    return _out(dashboard_summary(_marked_sites(spark, sf_dir)))


def _history(spark, sf_dir):
    return read_history(spark, land_history(spark, sf_dir))


@register("read_history")
def q_read_history(spark, sf_dir):
    return _out(_history(spark, sf_dir))


@register("history_top_n")
def q_history_top_n(spark, sf_dir):
    """The newest runs of every site (5, the all-sites view)."""
    return _out(newest_per_site(_history(spark, sf_dir), HISTORY_LIMIT_ALL_SITES))


@register("history_top_n_site")
def q_history_top_n_site(spark, sf_dir):
    """The newest runs of one site (20)."""
    return _out(newest_per_site(_history(spark, sf_dir), HISTORY_LIMIT_ONE_SITE, fx.RUN_SITE))


@register("history_retention")
def q_history_retention(spark, sf_dir):
    """The newest 100 runs of every site."""
    return _out(retain(_history(spark, sf_dir)))


@register("append_history")
def q_append_history(spark, sf_dir):
    """K7: a full run's rows appended to a stored history, with retention, read back."""
    _, res = _results(spark, sf_dir)
    path = scratch_path(spark, "history", unique=True)
    store_history(spark, path, _history(spark, sf_dir))
    store_history(spark, path, res)
    return _out(stored_history(spark, path))
