"""Registered queries against their DuckDB oracle SQL at sf0.001 (a fast
subset; tools/check_oracle.py runs all of them at sf0.01)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from playlake.plans import catalog
from playlake.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"
SUBSET = [
    "contract_errors_raw",
    "silver_strict",
    "quarantine_lenient",
    "content_daily",
    "platform_hourly",
    "content_hourly",
    "content_daily_served",
    "dim_join_part",
    "top_content_by_day_sql",
    "qoe_regression",
    "session_funnel",
    "run_summary",
    "upsert_result",
    "hourly_to_daily_rollup",
    "contract_broken",
    "mart_ordered",
    "sinks",
    "viewers_rollup",
    "approx_viewers",
    "lag_by_day",
    "freshness",
    "incremental_dedupe",
    "late_audit",
    "stream_run_summary",
    "stream_fan_out",
]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    yield con
    con.close()


def test_every_query_has_an_oracle_or_is_rows_only():
    # add-on packages register further queries and have their own tests
    assert set(catalog.QUERIES) <= set(E.queries())
    missing = set(catalog.QUERIES) - set(E.oracle_sql())
    assert not missing
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 759  # platform_hourly rows at sf0.001 (FIXTURES.md §2)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())
