"""Run history source (S7) and a history derived from the order data.

A history is an append-only table of run rows.  ``read_history`` returns an
empty frame with the schema when the table is missing or unreadable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.schema import HISTORY_SCHEMA
from shopfold.session import path_exists, scratch_path
from shopfold.sources.landing import site_of
from shopfold.sources.tables import read_table


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history table, or an empty frame when it cannot be read."""
    try:
        if path_exists(spark, path):
            return spark.read.schema(HISTORY_SCHEMA).parquet(path)
    except Exception:  # unreadable -> empty, as the original store does
        pass
    return spark.createDataFrame([], HISTORY_SCHEMA)


def history_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One past run per (site, order day): a history whose size follows the data.

    started_at = day + 06:00; the run took one second per order of that day;
    every fourth count is recorded as a failed run with 0 rows; the kind
    rotates with the day of month.
    """
    o = read_table(spark, sf_dir, "orders")
    day = (o.groupBy(site_of(F.col("o_orderkey")).alias("site_id"),
                     F.col("o_orderdate").alias("day"))
           .agg(F.count(F.lit(1)).alias("n")))
    started = F.col("day") + F.expr("INTERVAL 6 HOURS")
    err = F.col("n") % 4 == 0
    kind = F.dayofmonth("day") % 3
    return day.select(
        "site_id",
        started.alias("started_at"),
        (started + F.make_dt_interval(secs=F.col("n").cast("decimal(18,6)"))).alias("completed_at"),
        F.col("n").cast("long").alias("duration_seconds"),
        F.when(err, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.when(err, F.lit(0)).otherwise(F.col("n")).cast("long").alias("row_count"),
        F.when(kind == 0, F.lit("full")).when(kind == 1, F.lit("hourly"))
        .otherwise(F.lit("status_only")).alias("sync_type"),
        F.when(err, F.lit("HTTP 500")).alias("error"),
    )


def land_history(spark: SparkSession, sf_dir: str) -> str:
    tag = sf_dir.rstrip("/").replace("/", "_").replace(".", "_").strip("_")
    path = scratch_path(spark, "landing", tag, "history")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        history_from_orders(spark, sf_dir).write.mode("overwrite").parquet(path)
    return path
