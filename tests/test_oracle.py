"""Registered queries against their DuckDB oracle (subset by default).

Set SHOPFOLD_FULL_ORACLE=1 to check every registered query.
"""

import os

import pytest

from helpers import SF_SMALL
from oracle_harness import compare, duck

DEFAULT = ["flatten_gomag", "normalize_status", "dedup_latest", "merge_upsert", "sync_all",
           "merge_status_only", "merge_match", "sync_status_only", "sync_hourly", "run_result",
           "merge_named_sites", "drop_staging", "truncate_all", "append_history",
           "read_feed", "detect_columns", "parse_money", "history_top_n", "unwrap_envelope"]


def _names():
    from shopfold.plans.oracle import sql_catalog
    return sorted(sql_catalog()) if os.environ.get("SHOPFOLD_FULL_ORACLE") else DEFAULT


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    info = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert info["ok"], info


def test_every_query_has_an_oracle():
    from shopfold.plans.catalog import registry
    from shopfold.plans.oracle import sql_catalog
    assert set(registry()) == set(sql_catalog())


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0


_DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                  "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("name", _names())
def test_types_match_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF_SMALL)
    sp = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rel = con.sql(oracle_sql()[name])
    dk = {c: _DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert sp == dk
