"""Fact-table lifecycle on the session catalog (K1, K2, K5, K6, K8, and K3/K4 on a table).

The table is partitioned by site and order month.  Parquet tables in the session catalog refuse
``MERGE INTO``, so a merge is a DataFrame (:mod:`shopfold.operators.merge`) over the partitions
that the source can change: those that hold a matching key and those its rows belong to; if no
row of the table matches, the source is appended and nothing is rewritten.  The merged rows are staged as Parquet and written with a dynamic partition overwrite, so the other
months of a site, however large it is, are neither read in full nor rewritten.  One run writes a
table at a time, as the scheduled runs do.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.schema import FACT_DDL, MATCH_KEYS, STANDARD_COLUMNS
from shopfold.session import path_bytes, scratch_path

#: The partition of rows without an order date.
UNDATED = "undated"


def table_location(spark: SparkSession, name: str) -> str:
    """Default location: ``spark.shopfold.warehouse`` if set, else the shared checkpoint folder."""
    base = spark.conf.get("spark.shopfold.warehouse", None)
    return f"{base.rstrip('/')}/{name}" if base else scratch_path(spark, "tables", name)


def _q(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def ensure_table(spark: SparkSession, name: str, location: str | None = None) -> str:
    """K1: create the fact table if it does not exist (13 columns, by site and order month)."""
    loc = location or table_location(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({FACT_DDL}, order_month string) USING parquet "
              f"OPTIONS (compression 'zstd') PARTITIONED BY (source_site, order_month) LOCATION '{_q(loc)}'")
    return loc


def with_month(rows: DataFrame) -> DataFrame:
    month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit(UNDATED))
    return rows.select(*STANDARD_COLUMNS, month.alias("order_month"))


def _in_table_order(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Rows as ``insertInto`` takes them (by position, partition columns last).  The rebalance
    gives a small partition one file and a large one several, so a hot site is no single task."""
    return rows.select(*spark.table(name).columns).hint("rebalance", "source_site", "order_month")


def append_rows(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """K2: append rows (a no-op for an empty frame; Spark batches the writes)."""
    _in_table_order(spark, name, with_month(rows)).write.insertInto(name)


def read_sites_of(spark: SparkSession, name: str, sites: list[str]) -> DataFrame:
    """The current rows of some sites (static partition pruning)."""
    return spark.table(name).filter(F.col("source_site").isin(*sites)).select(*STANDARD_COLUMNS)


@contextmanager
def _overwriting(spark: SparkSession, mode: str):
    """Inserts into a table take the mode from the session only."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


# --- merge --------------------------------------------------------------------

def staging_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "staging", unique=True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """K6: remove a staging folder."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)


def store_rows(rows: DataFrame, path: str) -> None:
    """Rows stored for the next step, which reads them again."""
    rows.write.option("compression", "zstd").parquet(path)


def stage_source(spark: SparkSession, source: DataFrame, path: str, status_only: bool = False,
                 stored: bool = False) -> DataFrame:
    """The deduplicated source of a merge, written once: the merge reads it more than once, and
    the pipeline behind it runs once.  For a status-only merge, just the columns it takes.  A
    source that is not ``stored`` is, before the dedup reads it twice."""
    from shopfold.operators.merge import STATUS_COLS, dedup_stored
    kept = [*MATCH_KEYS, *STATUS_COLS] if status_only else STANDARD_COLUMNS
    rows = source.select(*kept, *(["item_pos"] if "item_pos" in source.columns else []))
    try:
        if not stored:
            store_rows(rows, f"{path}_rows")
            rows = spark.read.parquet(f"{path}_rows")
        rows = dedup_stored(rows, f"{path}_repeated")
        store_rows(rows.select(*kept) if status_only else with_month(rows), path)
    finally:
        drop_folder(spark, f"{path}_rows")
        drop_folder(spark, f"{path}_repeated")
    return spark.read.parquet(path)


def _partitions(rows: DataFrame) -> list[tuple[str, str]]:
    """The distinct (site, month) of some rows: a row for each partition, not for each order."""
    return sorted(tuple(r) for r in rows.select("source_site", "order_month").distinct().collect())


def held_partitions(spark: SparkSession, name: str, staged: DataFrame, sites: list[str]) -> list[tuple[str, str]]:
    """Partitions of these sites that hold a key of the source: an order may have been stored
    under another month than it has now.  Reads the four key columns only, and if the source is
    large, compares only the rows whose order may be in it."""
    keys = spark.table(name).filter(F.col("source_site").isin(*sites)).select(*MATCH_KEYS, "order_month")
    if not _is_small(spark, staged):
        keys = _maybe_in(keys, staged)
    return _partitions(keys.join(staged.select(*MATCH_KEYS), MATCH_KEYS, "left_semi"))


#: Stored bytes up to which a merge's source counts as small: a join can send it to every task.
SMALL_SOURCE = 8_000_000


def _is_small(spark: SparkSession, staged: DataFrame) -> bool:
    return sum(path_bytes(spark, f) for f in staged.inputFiles()) <= SMALL_SOURCE


# Bits of the map of orders, and of one of its rows: 4,096 rows of 4 KB, whatever the source's size.
_MAP_BITS, _ROW_BITS = 27, 15


def _maybe_in(keys: DataFrame, staged: DataFrame) -> DataFrame:
    """The rows of ``keys`` but those whose order is surely not in ``staged``, without a shuffle of
    either: each order of the source sets one bit of a map, which every task gets."""
    order = F.xxhash64("order_id", "source_site").bitwiseAND((1 << _MAP_BITS) - 1)
    at = order.bitwiseAND((1 << _ROW_BITS) - 1)
    maps = staged.groupBy(F.shiftright(order, _ROW_BITS).alias("_row")).agg(F.bitmap_construct_agg(at).alias("_map"))
    word = lambda i: F.conv(F.hex(F.substring("_map", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    words = F.transform(F.sequence(F.lit(0), F.lit((1 << _ROW_BITS) // 64 - 1)), word)
    maps = F.broadcast(maps.select("_row", words.alias("_words")))
    # A word has its eight bytes in reading order, the first of them highest.
    bit = (7 - F.shiftright(at, 3).bitwiseAND(7)) * 8 + at.bitwiseAND(7)
    told = keys.withColumns({"_at_row": F.shiftright(order, _ROW_BITS), "_at_word": F.shiftright(at, 6).cast("int"),
                             "_at_bit": bit.cast("int")})
    hit = F.getbit(F.get("_words", F.col("_at_word")), F.col("_at_bit")) == 1
    return told.join(maps, (F.col("_at_row") == F.col("_row")) & hit, "left_semi").select(*keys.columns)


def _in_partitions(partitions: list[tuple[str, str]]) -> Column:
    """A filter on the partition columns, so that other directories are not read."""
    months: dict[str, list[str]] = {}
    for site, month in partitions:
        months.setdefault(site, []).append(month)
    found = F.lit(False)
    for site, listed in months.items():
        found = found | ((F.col("source_site") == site) & F.col("order_month").isin(*listed))
    return found


def merge_into_table(spark: SparkSession, name: str, source: DataFrame, sites: list[str] | None = None,
                     status_only: bool = False, staging: str | None = None,
                     stored: bool = False) -> list[tuple[str, str]]:
    """K3/K4 on a table: merge ``source`` into the partitions it can change; returns those.

    With ``sites`` given, a row of another site is an error; a row without a site always is.
    ``stored``: the source is read from stored rows, so that reading it twice is cheap.  The
    staged source is dropped at the end, whatever happens (K6); the merged rows are dropped once
    they are in the table, so after a failed overwrite they can still be written.
    """
    from shopfold.operators.merge import merge_staged, merge_status_only, merge_upsert
    staging = staging or staging_folder(spark)
    try:
        staged = stage_source(spark, source, f"{staging}/source", status_only, stored)
        sited = staged.withColumn("source_site", F.coalesce("source_site", F.lit("")))
        # A status-only merge inserts nothing: the months of its source play no part.
        wanted = [] if status_only else _partitions(sited)
        touched = sorted({site for site, _ in wanted} if not status_only else
                         {r[0] for r in sited.select("source_site").distinct().collect()})
        if touched and touched[0] == "":
            raise ValueError("rows without a source_site cannot be merged")
        if sites is not None and (uncovered := sorted(set(touched) - set(sites))):
            raise ValueError(f"rows of sites outside the run: {uncovered}")
        if not touched:
            return []
        held = held_partitions(spark, name, staged, touched)
        changed = held if status_only else sorted({*held, *wanted})
        if not held:
            # No row of the table matches: nothing is rewritten, every row of the source is new.
            if wanted:
                append_rows(spark, name, staged)
            return changed
        # Of a site without a match every row is new: these are appended, the others joined.
        known = {site for site, _ in held}
        ours = sorted(p for p in changed if p[0] in known)
        target = spark.table(name).filter(_in_partitions(ours)).select(*STANDARD_COLUMNS)
        part = staged.filter(F.col("source_site").isin(*sorted(known)))
        if status_only:
            merged = merge_status_only(target, part, dedup=False)
        elif _is_small(spark, staged):
            merged = merge_staged(target, part)
        else:  # one join that moves either side once
            merged = merge_upsert(target, part, dedup=False)
        store_rows(with_month(merged), f"{staging}/merged")
        rows = spark.read.parquet(f"{staging}/merged")
        with _overwriting(spark, "dynamic"):
            _in_table_order(spark, name, rows).write.insertInto(name, overwrite=True)
        # Months that all their orders left are no part of the overwrite.
        for site, month in sorted(set(ours) - set(_partitions(rows))):
            _empty(spark, name, source_site=site, order_month=month)
        if not status_only and (others := sorted(set(touched) - known)):
            append_rows(spark, name, staged.filter(F.col("source_site").isin(*others)))
        drop_folder(spark, f"{staging}/merged")
        return changed
    finally:
        drop_folder(spark, f"{staging}/source")


# --- truncate -----------------------------------------------------------------

def _empty(spark: SparkSession, name: str, **fixed: str) -> None:
    """Overwrite a partition (or all with a fixed site, or all) with no rows."""
    spec = ", ".join(f"{c}='{_q(fixed[c])}'" if c in fixed else c for c in ("source_site", "order_month"))
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
                        for f in spark.table(name).schema.fields if f.name not in fixed)
    with _overwriting(spark, "static"):
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {columns} WHERE false")


def truncate_table(spark: SparkSession, name: str, sites: list[str] | None = None) -> None:
    """K5: empty the table, or some sites (``TRUNCATE TABLE`` refuses tables with a location)."""
    if sites is None:
        _empty(spark, name)
    for site in sites or []:
        _empty(spark, name, source_site=site)


def truncate_all(spark: SparkSession, name: str, sites: list[str]) -> list[tuple[str, str, str]]:
    """K5 over every site: one (site_id, table, status) per site; errors are kept per site."""
    out = []
    for site in sites:
        try:
            truncate_table(spark, name, [site])
            out.append((site, name, "truncated"))
        except Exception as e:  # keep going, like the original loop
            out.append((site, name, f"error: {e}"))
    return out


def export_csv(rows: DataFrame, path: str) -> None:
    """K8: CSV export with a header row.

    NULL is written as ``\\N`` so that an empty string stays an empty string
    (``""``) when the file is read back.
    """
    (rows.write.mode("error").option("header", True).option("nullValue", "\\N")
     .option("emptyValue", '""').csv(path))


def read_csv_export(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.option("header", True).option("nullValue", "\\N")
            .option("emptyValue", "").schema(schema).csv(path))
