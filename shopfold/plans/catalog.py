"""Registered queries: one per operator of the inventory.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
work grows with the driver tables.  Column names match the SQL oracle in
:mod:`shopfold.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.operators.flatten import fact_columns, flatten_orders, placeholders
from shopfold.operators.merge import dedup_latest, merge_status_only, merge_upsert
from shopfold.operators.status import normalize_status
from shopfold.plans import fixture as fx
from shopfold.schema import STANDARD_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


def registry() -> dict[str, Query]:
    # Importing the query modules fills the registry.
    from shopfold.plans import q_detect, q_functions, q_runs, q_sources, q_tables  # noqa: F401
    return dict(_REGISTRY)


def _out(df: DataFrame) -> DataFrame:
    return fx.for_compare(df)


# --- flatteners --------------------------------------------------------------

def _flat(spark, sf_dir, platform=None, as_of=fx.AS_OF):
    return flatten_orders(fx.raw(spark, sf_dir, platform), as_of,
                          platforms=fx.platforms(spark, sf_dir, platform))


@register("flatten_woocommerce")
def q_flatten_woocommerce(spark, sf_dir):
    return _out(fact_columns(_flat(spark, sf_dir, "woocommerce")))


@register("flatten_gomag")
def q_flatten_gomag(spark, sf_dir):
    return _out(fact_columns(_flat(spark, sf_dir, "gomag")))


@register("flatten_merchantpro")
def q_flatten_merchantpro(spark, sf_dir):
    return _out(fact_columns(_flat(spark, sf_dir, "merchantpro")))


@register("placeholder_row")
def q_placeholder_row(spark, sf_dir):
    return _out(fact_columns(placeholders(_flat(spark, sf_dir))))


# --- status, dedup, merge ------------------------------------------------------

def _normalized(spark, sf_dir, as_of=fx.AS_OF):
    return flatten_orders(fx.raw(spark, sf_dir), as_of, fx.mappings(spark, sf_dir),
                          fx.platforms(spark, sf_dir))


@register("normalize_status")
def q_normalize_status(spark, sf_dir):
    return _out(fact_columns(_normalized(spark, sf_dir)))


@register("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    rows = _normalized(spark, sf_dir).select(*STANDARD_COLUMNS, "item_pos")
    return _out(fact_columns(dedup_latest(rows)))


def merge_target(spark, sf_dir):
    """An earlier run over old orders (statuses not yet updated, duplicate keys kept),
    stored as a table partitioned by site."""
    def build():
        return (fact_columns(_flat(spark, sf_dir, as_of=fx.TARGET_SYNCED_AT))
                .filter(F.col("order_date") < F.lit(fx.TARGET_END))
                .withColumn("order_status", F.lit(fx.TARGET_STATUS)))
    t = fx.materialized(spark, sf_dir, "merge_target", build, ["source_site"])
    return t.select(*STANDARD_COLUMNS)


def merge_inputs(spark, sf_dir):
    """Target: :func:`merge_target`; source: a run over orders from SOURCE_START on."""
    target = merge_target(spark, sf_dir)
    source = (_normalized(spark, sf_dir)
              .filter(F.col("order_date") >= F.lit(fx.SOURCE_START))
              .select(*STANDARD_COLUMNS, "item_pos"))
    return target, source


@register("merge_upsert")
def q_merge_upsert(spark, sf_dir):
    target, source = merge_inputs(spark, sf_dir)
    return _out(merge_upsert(target, source))


@register("merge_status_only")
def q_merge_status_only(spark, sf_dir):
    target, source = merge_inputs(spark, sf_dir)
    return _out(merge_status_only(target, source))
