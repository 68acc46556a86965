"""Labels and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopfold.schema import UNMAPPED_PREFIX


def slugify(name: Column) -> Column:
    """lower-case, runs of non [a-z0-9] to '-', one '-' trimmed at each end."""
    s = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-")
    return F.regexp_replace(s, "^-|-$", "")


def table_name_for(slug: Column) -> Column:
    """Default table name of a site: ``orders_`` + slug with '-' as '_'."""
    return F.concat(F.lit("orders_"), F.regexp_replace(slug, "-", "_"))


def format_duration(seconds: Column) -> Column:
    """``'Ns'`` under a minute, else ``'Mm Ss'``."""
    s = seconds.cast("long")
    return (F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
            .otherwise(F.concat(F.floor(s / 60).cast("string"), F.lit("m "),
                                (s % 60).cast("string"), F.lit("s"))))


def relative_time(ts: Column, as_of: Column) -> Column:
    """'just now' / 'Nm ago' / 'Nh ago' / dd.MM.yyyy relative to ``as_of``.

    Minutes are floored from the millisecond difference, as the dashboard does.
    NULL input gives ''.
    """
    diff_ms = F.unix_millis(as_of) - F.unix_millis(ts)
    mins = F.floor(diff_ms / F.lit(60000))
    hours = F.floor(mins / F.lit(60))
    return (F.when(ts.isNull(), F.lit(""))
            .when(mins < 1, F.lit("just now"))
            .when(mins < 60, F.concat(mins.cast("string"), F.lit("m ago")))
            .when(hours < 24, F.concat(hours.cast("string"), F.lit("h ago")))
            .otherwise(F.date_format(ts, "dd.MM.yyyy")))


def truncate_sample(text: Column, limit: int = 60, keep: int = 57) -> Column:
    """NULL -> '—'; longer than ``limit`` -> first ``keep`` chars + '…'."""
    return (F.when(text.isNull(), F.lit("—"))
            .when(F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit("…")))
            .otherwise(text))


def unmapped_label(raw_status: Column) -> Column:
    return F.concat(F.lit(UNMAPPED_PREFIX), raw_status)
