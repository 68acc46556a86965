"""Table lifecycle, history retention, feed membership, streaming = batch."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from helpers import SF_SMALL
from shopfold.operators.feed import feed_membership
from shopfold.operators.history import append_history, retain, store_history, stored_history
from shopfold.operators.tables import append_rows, ensure_table, merge_into_table, truncate_table
from shopfold.plans import fixture as fx
from shopfold.plans.catalog import merge_inputs, registry
from shopfold.schema import FACT_SCHEMA, HISTORY_SCHEMA, STANDARD_COLUMNS


def _table(spark, prefix, rows=None):
    name = f"{prefix}_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, name)
    if rows is not None:
        append_rows(spark, name, rows)
    return name


def _content(spark, name):
    return sorted(map(tuple, spark.table(name).select(*STANDARD_COLUMNS).collect()))


def test_merge_is_idempotent_and_drops_its_staging(spark):
    from shopfold.operators.tables import staging_folder
    from shopfold.session import path_exists
    target, source = merge_inputs(spark, SF_SMALL)
    sites = [r.site_id for r in fx.sites(spark, SF_SMALL).collect()]
    name, staging = _table(spark, "t_merge", target), staging_folder(spark)
    n_target = spark.table(name).count()
    merge_into_table(spark, name, source, sites, staging=staging)
    once = _content(spark, name)
    merge_into_table(spark, name, source, sites)
    assert _content(spark, name) == once and len(once) >= n_target
    assert not path_exists(spark, f"{staging}/source") and not path_exists(spark, f"{staging}/merged")


def test_status_only_keeps_rows_and_amounts(spark):
    target, source = merge_inputs(spark, SF_SMALL)
    sites = [r.site_id for r in fx.sites(spark, SF_SMALL).collect()]
    name = _table(spark, "t_status", target)
    merge_into_table(spark, name, source, sites, status_only=True)
    after = spark.table(name)
    assert after.count() == target.count()
    cols = [c for c in STANDARD_COLUMNS if c not in ("order_status", "synced_at")]
    assert after.select(*cols).exceptAll(target.select(*cols)).count() == 0
    empty = _table(spark, "t_none")
    assert merge_into_table(spark, empty, source, status_only=True) == []
    assert spark.table(empty).count() == 0


def test_append_and_truncate(spark):
    target, _ = merge_inputs(spark, SF_SMALL)
    name = _table(spark, "t_trunc", target)
    assert spark.table(name).count() == target.count()
    truncate_table(spark, name, ["store_0"])
    assert spark.table(name).filter("source_site = 'store_0'").count() == 0
    assert spark.table(name).count() == target.filter("source_site <> 'store_0'").count()
    truncate_table(spark, name)
    assert spark.table(name).count() == 0
    append_rows(spark, name, target)
    assert spark.table(name).count() == target.count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_merge_loses_no_site(spark):
    import pytest
    target, source = merge_inputs(spark, SF_SMALL)
    name = _table(spark, "t_sites")
    with pytest.raises(ValueError):
        merge_into_table(spark, name, source, ["store_0"])
    with pytest.raises(ValueError):
        merge_into_table(spark, name, target.withColumn("source_site", F.lit(None).cast("string")))
    assert spark.table(name).count() == 0
    odd = target.withColumn("source_site", F.concat(F.lit("a:b/c=%', x"), F.substring("source_site", 7, 1)))
    merge_into_table(spark, name, odd)
    assert spark.table(name).groupBy("source_site").count().count() == odd.select("source_site").distinct().count()
    truncate_table(spark, name, ["a:b/c=%', x0"])
    assert spark.table(name).filter("source_site = \"a:b/c=%', x0\"").count() == 0


def test_merge_rewrites_only_the_partitions_it_changes(spark):
    """Files of other sites and months stay; a key stored under another month is found and moved."""
    def row(order, day, site="s", sku="k", status="order_processed"):
        d = None if day is None else dt.datetime.fromisoformat(day)
        return (order, d, status, 1.0, "RON", "p", sku, "n", 1.0, 1, 1.0, site, dt.datetime(2024, 1, 1))

    from shopfold.schema import FACT_SCHEMA
    frame = lambda *rows: spark.createDataFrame(list(rows), FACT_SCHEMA)
    name = _table(spark, "t_touch", frame(
        row("1", "2024-01-05"), row("2", "2024-02-05"), row("2", "2024-02-05"), row("3", "2024-03-05"),
        row("4", None), row("1", "2024-01-05", "other")))
    files = lambda: {r[0]: r[1] for r in spark.table(name).select(
        F.concat_ws("/", "source_site", "order_month").alias("at"), F.input_file_name().alias("file"))
        .groupBy("at").agg(F.collect_set("file")).collect()}
    before = files()
    changed = merge_into_table(spark, name, frame(
        row("2", "2024-03-07", status="order_cancelled"), row("5", "2024-04-01"), row("4", "2024-04-02")))
    assert changed == [("s", "2024-02"), ("s", "2024-03"), ("s", "2024-04"), ("s", "undated")]
    after = files()
    assert set(after) == {"s/2024-01", "s/2024-03", "s/2024-04", "other/2024-01"}
    assert all(after[p] == before[p] for p in ("s/2024-01", "other/2024-01"))
    got = sorted((r.order_id, r.order_status, r.order_month) for r in spark.table(name).filter("source_site = 's'").collect())
    assert got == [("1", "order_processed", "2024-01"), ("2", "order_cancelled", "2024-03"),
                   ("2", "order_cancelled", "2024-03"), ("3", "order_processed", "2024-03"),
                   ("4", "order_processed", "2024-04"), ("5", "order_processed", "2024-04")]


def test_stored_history_overwrites_only_the_runs_sites(spark):
    from shopfold.session import scratch_path
    path = scratch_path(spark, "history", unique=True)
    assert stored_history(spark, path).count() == 0
    base = dt.datetime(2024, 1, 1)
    runs = lambda site, hours: spark.createDataFrame([
        (site, base + dt.timedelta(hours=h), base + dt.timedelta(hours=h), 0, "success", h, "full", None)
        for h in hours], HISTORY_SCHEMA)
    store_history(spark, path, runs("a", range(100)).unionAll(runs("b", range(3))))
    before = {r[0] for r in spark.read.parquet(path).filter("site_id = 'b'").select(F.input_file_name()).collect()}
    store_history(spark, path, runs("a", [200]))
    h = stored_history(spark, path)
    assert h.columns == HISTORY_SCHEMA.names
    counts = {r.site_id: (r.n, r.low) for r in h.groupBy("site_id").agg(
        F.count("*").alias("n"), F.min("row_count").alias("low")).collect()}
    assert counts == {"a": (100, 1), "b": (3, 0)}
    assert before == {r[0] for r in spark.read.parquet(path).filter("site_id = 'b'").select(F.input_file_name()).collect()}


def test_history_keeps_newest_100(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("s", base + dt.timedelta(hours=i), base + dt.timedelta(hours=i, seconds=5), 5,
             "success", i, "full", None) for i in range(101)]
    h = spark.createDataFrame(rows, HISTORY_SCHEMA)
    kept = retain(h).collect()
    assert len(kept) == 100 and min(r.row_count for r in kept) == 1
    new = spark.createDataFrame([("s", base + dt.timedelta(days=30), base + dt.timedelta(days=30),
                                  0, "error", 0, "hourly", "boom")], HISTORY_SCHEMA)
    kept2 = append_history(h, new).collect()
    assert len(kept2) == 100 and any(r.error == "boom" for r in kept2)


def test_site_without_feed_gives_null(spark):
    rows = spark.createDataFrame([("a", "1", "p1"), ("a", "2", "p2"), ("b", "3", "p1")],
                                 "source_site string, order_id string, product_id string")
    feed = spark.createDataFrame([("a", "p1")], "source_site string, product_id string")
    sites = spark.createDataFrame([("a", "url"), ("b", None)],
                                  "site_id string, product_feed_url string")
    got = sorted((r.order_id, r.in_feed) for r in feed_membership(rows, feed, sites).collect())
    assert got == [("1", True), ("2", False), ("3", None)]


def test_stream_equals_batch(spark):
    q = registry()
    stream = q["stream_upsert"](spark, SF_SMALL)
    batch = q["dedup_latest"](spark, SF_SMALL)
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).count() == 0


def test_unknown_and_disabled_sites_raise(spark):
    import pytest
    from shopfold.plans.sync import check_site
    sites = fx.sites(spark, SF_SMALL)
    with pytest.raises(KeyError):
        check_site(spark, sites, "nope")
    with pytest.raises(ValueError):
        check_site(spark, sites, "store_5")
    check_site(spark, sites, "store_0")
    assert F is not None


def _facts(spark, rows):
    """Fact rows of (order_id, product_id, site, day, status, item_pos); the rest is fixed."""
    given = spark.createDataFrame(rows, "order_id string, product_id string, source_site string, "
                                  "order_date timestamp, order_status string, item_pos int")
    fixed = {"product_sku": F.lit("s"), "synced_at": F.lit(dt.datetime(2001, 1, 1)).cast("timestamp")}
    return given.select(*[F.col(f.name) if f.name in given.columns else
                          fixed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
                          for f in FACT_SCHEMA.fields], "item_pos")


def _files(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def test_merge_without_a_match_appends_and_rewrites_nothing(spark):
    day = dt.datetime(2000, 5, 3)
    old = _facts(spark, [("1", "a", "s", day, "x", 0), ("1", "a", "s", day, "x", 1), (None, "a", "s", day, "x", 0)])
    name = _table(spark, "t_new", old)
    before = _files(spark, name)
    new = _facts(spark, [("2", "a", "s", day, "first", 0), ("2", "a", "s", day, "last", 1),
                         (None, "a", "s", day, "y", 0), ("3", "a", "t", None, "z", 0)])
    assert merge_into_table(spark, name, new) == [("s", "2000-05"), ("t", "undated")]
    assert before < _files(spark, name)
    found = [tuple(r) for r in spark.table(name).select("order_id", "source_site", "order_status").collect()]
    assert sorted(found, key=str) == sorted([
        ("1", "s", "x"), ("1", "s", "x"), (None, "s", "x"), ("2", "s", "last"), (None, "s", "y"), ("3", "t", "z")],
        key=str)
    # The next merge finds the keys and changes them in place.
    merge_into_table(spark, name, new.filter("order_id = '2'").withColumn("order_status", F.lit("again")))
    assert sorted(r[0] for r in spark.table(name).filter("order_id = '2'").select("order_status").collect()) == ["again"]


def test_status_only_carries_only_what_it_takes(spark, tmp_path):
    from shopfold.operators.merge import merge_status_only
    from shopfold.operators.tables import stage_source
    day = dt.datetime(2000, 5, 3)
    target = _facts(spark, [("1", "a", "s", day, "old", 0), ("2", "a", "s", day, "old", 0), (None, "a", "s", day, "old", 0)])
    source = _facts(spark, [("1", "a", "s", day, "first", 0), ("1", "a", "s", day, "last", 1), (None, "a", "s", day, "n", 0)])
    staged = stage_source(spark, source, str(tmp_path / "staged"), status_only=True)
    assert set(staged.columns) == {"order_id", "product_id", "product_sku", "source_site", "order_status", "synced_at"}
    merged = merge_status_only(target, source)
    plan = merged._jdf.queryExecution().optimizedPlan().toString().splitlines()
    packed = [x for x in plan if "max_by" in x]
    assert packed and not any("order_total" in x or "order_date" in x for x in packed)
    assert sorted(map(str, merged.select("order_id", "order_status").collect())) == sorted(
        map(str, spark.createDataFrame([("1", "last"), ("2", "old"), (None, "old")], "order_id string, order_status string")
            .collect()))


def test_truncate_all_flattens_once(spark, monkeypatch):
    from shopfold.plans import q_tables
    from shopfold.session import path_exists
    loads, stored = [], []
    append, store = q_tables.append_rows, q_tables.store_rows
    monkeypatch.setattr(q_tables, "append_rows", lambda s, n, rows: (loads.append(rows.inputFiles()), append(s, n, rows)))
    monkeypatch.setattr(q_tables, "store_rows", lambda rows, path: (stored.append(path), store(rows, path)))
    rows = registry()["truncate_all"](spark, SF_SMALL).collect()
    assert len(stored) == 1 and len(loads) == 2
    assert all(f.endswith(".parquet") and stored[0] in f for files in loads for f in files)
    assert not path_exists(spark, stored[0])
    assert rows and all(r.rows_after == 0 and r.rows_again > 0 for r in rows)


def test_tables_are_stored_compressed_well(spark):
    name = _table(spark, "t_zstd", _facts(spark, [("1", "a", "s", None, "x", 0)]).drop("item_pos"))
    assert all(f.endswith(".zstd.parquet") for f in _files(spark, name))


def test_dedup_of_stored_rows_sends_only_repeated_keys_through_the_dedup(spark, tmp_path, monkeypatch):
    from shopfold.operators import merge
    day = dt.datetime(2000, 5, 3)
    rows = [(str(k), "a", "s", day, "x", 0) for k in range(50)]
    rows += [("7", "a", "s", day, "last", 1), (None, "a", "s", day, "first", 0), (None, "a", "s", None, "last", 3),
             ("7", None, "s", day, "y", 0), ("7", "a", None, day, "z", 0)]
    _facts(spark, rows).coalesce(1).write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    given, dedup = [], merge.dedup_latest
    monkeypatch.setattr(merge, "dedup_latest", lambda r, keys: given.append(r.count()) or dedup(r, keys))
    as_text = lambda df: sorted(map(str, df.collect()))
    expected = as_text(dedup(stored))
    found = merge.dedup_stored(stored, str(tmp_path / "repeated"))
    assert len(expected) == 53 and as_text(found) == expected and found.columns == stored.columns
    assert given == [4]  # order 7 and the order without an id, twice each
    monkeypatch.setattr(merge, "MOST_REPEATED", 1)
    assert as_text(merge.dedup_stored(stored, str(tmp_path / "many"))) == expected and given == [4, 55]
    unique = stored.filter("order_id <> '7'")
    assert as_text(merge.dedup_stored(unique, str(tmp_path / "none"))) == as_text(unique) and given == [4, 55]


def test_map_of_orders_loses_no_row_and_spares_the_others_a_shuffle(spark, tmp_path, monkeypatch):
    from shopfold.operators import tables
    day = lambda k: dt.datetime(2000, 1 + k % 12, 3)
    name = _table(spark, "t_map", _facts(spark, [(str(k), "a", "s", day(k), "x", 0) for k in range(3000)]
                                         + [(None, "a", "s", day(0), "x", 0)]).drop("item_pos"))
    source = _facts(spark, [(str(k), "a", "s", day(5), "new", 0) for k in range(0, 3000, 24)]
                    + [(None, "a", "s", day(3), "n", 0), ("7", "other", "s", day(3), "n", 0)])
    staged = tables.stage_source(spark, source, str(tmp_path / "staged"))
    small = tables.held_partitions(spark, name, staged, ["s"])
    assert small == [("s", "2000-01")]
    keys = spark.table(name).select("order_id", "product_id", "product_sku", "source_site", "order_month")
    kept = {r.order_id for r in tables._maybe_in(keys, staged).collect()}
    assert {str(k) for k in range(0, 3000, 24)} <= kept and len(kept) < 200
    monkeypatch.setattr(tables, "SMALL_SOURCE", -1)
    assert tables.held_partitions(spark, name, staged, ["s"]) == small


def test_large_and_small_sources_merge_alike_and_new_sites_are_appended(spark, monkeypatch):
    from shopfold.operators import tables
    day, later = dt.datetime(2000, 5, 3), dt.datetime(2000, 6, 3)
    old = _facts(spark, [("1", "a", "s", day, "x", 0), ("1", "a", "s", day, "x", 1), ("2", "a", "s", day, "x", 0),
                         (None, "a", "s", day, "x", 0), ("9", "a", "t", day, "x", 0)])
    new = _facts(spark, [("1", "a", "s", later, "y", 0), ("3", "a", "s", day, "y", 0), (None, "a", "s", day, "y", 0),
                         ("1", "a", "t", day, "y", 0), ("1", "a", "u", None, "y", 0)])
    expected = sorted(map(str, [("1", "s", "y"), ("1", "s", "y"), ("2", "s", "x"), ("3", "s", "y"), (None, "s", "x"),
                                (None, "s", "y"), ("9", "t", "x"), ("1", "t", "y"), ("1", "u", "y")]))
    for limit in (tables.SMALL_SOURCE, -1):
        monkeypatch.setattr(tables, "SMALL_SOURCE", limit)
        name = _table(spark, "t_both", old.drop("item_pos"))
        other = {f for f in _files(spark, name) if "source_site=t" in f}
        assert merge_into_table(spark, name, new) == [
            ("s", "2000-05"), ("s", "2000-06"), ("t", "2000-05"), ("u", "undated")]
        assert other and other < _files(spark, name)  # the site's key is new: its file stays as it is
        assert sorted(map(str, map(tuple, spark.table(name).select("order_id", "source_site", "order_status").collect()))
                      ) == expected


def test_queries_that_merge_twice_flatten_once(spark, monkeypatch):
    from shopfold.plans import q_tables
    from shopfold.session import path_exists
    for query in ("merge_named_sites", "merge_moved_months"):
        stored, merged, store, merge = [], [], q_tables.store_rows, q_tables.merge_into_table
        with monkeypatch.context() as m:
            m.setattr(q_tables, "store_rows", lambda rows, path: (stored.append(path), store(rows, path)))
            m.setattr(q_tables, "merge_into_table", lambda s, n, rows, **kw: (
                merged.append(rows.inputFiles()), merge(s, n, rows, **kw)))
            registry()[query](spark, SF_SMALL)
        assert len(stored) == 1 and merged
        assert all(f.endswith(".parquet") and stored[0] in f for files in merged for f in files)
        assert not path_exists(spark, stored[0])
