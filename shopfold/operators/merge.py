"""Dedup and MERGE semantics as joins.

Parquet tables in the session catalog do not support ``MERGE INTO``, so the
upserts are pure ``(target, source) -> new target`` functions; the snapshot
writer in :mod:`shopfold.operators.tables` installs the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.schema import MATCH_KEYS, STANDARD_COLUMNS

_VALUE_COLS = [c for c in STANDARD_COLUMNS if c not in MATCH_KEYS]
#: What a status-only merge takes from its source.
STATUS_COLS = ["order_status", "synced_at"]


def dedup_latest(rows: DataFrame, keys: list[str] = MATCH_KEYS) -> DataFrame:
    """One row per key, the latest ``synced_at``; ties -> the last item.

    Written as ``groupBy + max_by`` instead of ``row_number() over (...) = 1``:
    ``max_by`` is a declarative aggregate, so Spark combines map-side before
    the shuffle and a hot key (one order with many equal lines) is reduced in
    every map task instead of landing whole in one reducer.
    """
    has_pos = "item_pos" in rows.columns
    order = F.struct(F.col("synced_at"), F.col("item_pos") if has_pos else F.lit(0))
    others = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_r"))
    return picked.select(*keys, *[F.col("_r." + c).alias(c) for c in others]).select(
        *rows.columns)


#: Most repeated keys that :func:`dedup_stored` sends to every task.
MOST_REPEATED = 1_000_000


def dedup_stored(rows: DataFrame, path: str, keys: list[str] = MATCH_KEYS) -> DataFrame:
    """W1 over stored rows, which may be read twice: the same rows as :func:`dedup_latest`.

    Most keys occur once, and their rows need not meet any other.  A first pass sends eight bytes
    a row, a hash of its key; the hashes that come more than once are stored under ``path``, and
    only their rows go through the dedup.  Where keys repeat so often that their hashes are no
    small table, every row does.
    """
    spark = rows.sparkSession
    keyed = F.xxhash64(*keys)
    (rows.groupBy(keyed.alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
     .write.parquet(path))
    repeated = spark.read.parquet(path)
    n = repeated.count()
    if n > MOST_REPEATED:
        return dedup_latest(rows, keys)
    if not n:
        return rows
    hashed, repeated = rows.withColumn("_hash", keyed), F.broadcast(repeated)
    once = hashed.join(repeated, "_hash", "left_anti").select(*rows.columns)
    return once.unionByName(dedup_latest(
        hashed.join(repeated, "_hash", "left_semi").select(*rows.columns), keys))


def _matched_source(source: DataFrame, cols: list[str]) -> DataFrame:
    return source.select(*MATCH_KEYS, *[F.col(c).alias("_s_" + c) for c in cols],
                         F.lit(True).alias("_matched"))


def merge_upsert(target: DataFrame, source: DataFrame, dedup: bool = True) -> DataFrame:
    """K3: MERGE on the four keys (plain ``=``: NULL keys never match).

    * target rows with a source match take every source value (a NULL source
      value overwrites: the match is a flag, not a coalesce),
    * target rows without a match are kept as they are (duplicates included:
      each duplicate matches the one deduplicated source row),
    * source rows without a match are inserted.

    Plan: one ``FULL OUTER JOIN`` on the keys.  The deduplicated source is
    already hash-partitioned on the keys by its aggregation, so only the
    target is shuffled, and the source pipeline runs once.  (A left join plus
    an anti join would read the source twice: Catalyst pushes the inferred
    ``isnotnull(keys)`` of the left join through the dedup aggregate, which
    makes the two branches differ and defeats exchange reuse.)
    """
    src = dedup_latest(source.select(*STANDARD_COLUMNS, *(
        ["item_pos"] if "item_pos" in source.columns else []))) if dedup else source
    s = _matched_source(src.select(*STANDARD_COLUMNS), _VALUE_COLS)
    tgt = target.select(*STANDARD_COLUMNS)
    j = tgt.join(s, MATCH_KEYS, "full_outer")
    return j.select(*[
        F.when(F.col("_matched"), F.col("_s_" + c)).otherwise(F.col(c)).alias(c)
        if c in _VALUE_COLS else F.col(c) for c in STANDARD_COLUMNS])


def merge_staged(target: DataFrame, staged: DataFrame) -> DataFrame:
    """K3 with a source that is already deduplicated and stored: same rows as
    :func:`merge_upsert`, as a left join plus an anti join on the keys.  Reading a stored source
    twice costs little, a small source can be broadcast, and the anti join reads the target's
    four key columns only."""
    s = _matched_source(staged.select(*STANDARD_COLUMNS), _VALUE_COLS)
    tgt = target.select(*STANDARD_COLUMNS)
    kept = tgt.join(s, MATCH_KEYS, "left").select(*[
        F.when(F.col("_matched"), F.col("_s_" + c)).otherwise(F.col(c)).alias(c)
        if c in _VALUE_COLS else F.col(c) for c in STANDARD_COLUMNS])
    new = staged.select(*STANDARD_COLUMNS).join(target.select(*MATCH_KEYS), MATCH_KEYS, "left_anti")
    return kept.unionByName(new.select(*STANDARD_COLUMNS))


def merge_status_only(target: DataFrame, source: DataFrame, dedup: bool = True) -> DataFrame:
    """K4: matched target rows take ``order_status`` and ``synced_at``; no inserts.

    The dedup packs its columns in one struct, which Spark can't prune: the others go before it.
    """
    cols = STATUS_COLS
    src = dedup_latest(source.select(*MATCH_KEYS, *cols, *(
        ["item_pos"] if "item_pos" in source.columns else []))) if dedup else source
    s = _matched_source(src, cols)
    tgt = target.select(*STANDARD_COLUMNS)
    return tgt.join(s, MATCH_KEYS, "left").select(*[
        F.when(F.col("_matched"), F.col("_s_" + c)).otherwise(F.col(c)).alias(c)
        if c in cols else F.col(c) for c in STANDARD_COLUMNS])
