"""History windows and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfold.schema import HISTORY_KEEP_PER_SITE, HISTORY_SCHEMA
from shopfold.session import path_exists, scratch_path


def newest_per_site(history: DataFrame, n: int, site_id: str | None = None) -> DataFrame:
    """The newest ``n`` runs per site (``rn`` = 1 is the newest).

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so each map task forwards at most ``n`` rows per site
    and a site holding most of the history does not land whole in one task.
    """
    h = history if site_id is None else history.filter(F.col("site_id") == site_id)
    w = Window.partitionBy("site_id").orderBy(F.col("started_at").desc(),
                                              F.col("completed_at").desc())
    return h.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def retain(history: DataFrame, keep: int = HISTORY_KEEP_PER_SITE) -> DataFrame:
    """Keep the newest ``keep`` runs of every site."""
    return newest_per_site(history, keep).drop("rn")


def append_history(history: DataFrame, runs: DataFrame,
                   keep: int = HISTORY_KEEP_PER_SITE) -> DataFrame:
    """K7: add new run rows (newest first) and apply the retention."""
    return retain(history.unionByName(runs.select(*history.columns)), keep)


def stored_history(spark: SparkSession, path: str) -> DataFrame:
    """The history under ``path`` (empty if there is none)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(path).select(*HISTORY_SCHEMA.names)


def store_history(spark: SparkSession, path: str, runs: DataFrame,
                  keep: int = HISTORY_KEEP_PER_SITE) -> None:
    """K7: add ``runs`` to the stored history and apply the retention.  The history is partitioned
    by site, and only the sites of the runs are read and overwritten (from a staged copy)."""
    staging = scratch_path(spark, "staging", unique=True)
    new = runs.select(*HISTORY_SCHEMA.names)
    old = stored_history(spark, path).join(new.select("site_id").distinct(), "site_id", "left_semi")
    append_history(old.select(*HISTORY_SCHEMA.names), new, keep).write.parquet(staging)
    (spark.read.schema(HISTORY_SCHEMA).parquet(staging).repartition("site_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("site_id").parquet(path))
