"""Run-window and selection predicates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfold.schema import DEFAULT_LOOKBACK_DAYS


def as_of_col(as_of) -> Column:
    return F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of


def lookback_since(as_of, lookback_days: Column | int | None) -> Column:
    """``as_of - (lookback_days ?? 30) days`` (exact 24h days, like ms arithmetic)."""
    days = F.coalesce(lookback_days if isinstance(lookback_days, Column)
                      else F.lit(lookback_days), F.lit(DEFAULT_LOOKBACK_DAYS))
    return as_of_col(as_of) - F.make_dt_interval(days.cast("int"))


def today_since(as_of) -> Column:
    """midnight of ``as_of``'s day (UTC session time zone)."""
    return F.date_trunc("day", as_of_col(as_of))


def since_predicate(since: Column) -> Column:
    """F1 + F2 as one predicate on order-level columns (see :func:`since_filter`)."""
    ts = F.col("order_date")
    gomag = F.col("platform") == "gomag"
    return (F.when(gomag, (F.col("order_date_text") != "") & (ts.isNull() | (ts >= since)))
            .otherwise(ts.isNull() | (ts > since)))


def since_filter(rows: DataFrame, since: Column) -> DataFrame:
    """F1 + F2 on flattened rows (every row carries its order's date).

    WooCommerce / MerchantPro: the API returns orders created strictly after
    ``since``.  GoMag: newest-first pages are read until the first older
    order, undated orders are skipped and unparsable dates are kept (a NaN
    compare is false) -- on newest-first input that is ``date >= since``.
    Rows whose date does not parse are kept so they surface as rejects.
    """
    return rows.filter(since_predicate(since))


def enabled_sites(sites: DataFrame) -> DataFrame:
    """sites a full or status run covers."""
    return sites.filter(F.col("enabled"))


def hourly_sites(sites: DataFrame) -> DataFrame:
    """sites of the hourly run."""
    return sites.filter(F.col("enabled") & F.coalesce(F.col("hourly_sync_enabled"), F.lit(False)))


def nonblank(col: Column) -> Column:
    """text that is not empty after trimming."""
    return col.isNotNull() & (F.trim(col) != "")


def to_ts(value: str | _dt.datetime) -> _dt.datetime:
    if isinstance(value, _dt.datetime):
        return value
    return _dt.datetime.fromisoformat(value)
