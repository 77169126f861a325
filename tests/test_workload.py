"""Registered queries against their SQL on the smallest data set, where both are at hand.

All of them run with ``HRFLOW_ALL_QUERIES=1`` (some minutes); a cross-section runs by default.
"""

from __future__ import annotations

import os
from unittest import mock

import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, rows
from workload import contracts
from workload.registry import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = """land_metadata latest_per_record flatten_json unfurl_children scd2_history as_of_join active_intervals
headcount_snapshot mart_workforce manager_chain candidate_bridge mart_funnel stage_history q03 q05 q23
metric_total_attrition_rate dq_scd2_overlap erase_person identity_match time_to_hire_median""".split()
NAMES = sorted(QUERIES) if os.environ.get("HRFLOW_ALL_QUERIES") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return c


def test_every_query_has_a_check():
    assert set(CHECKS) == set(QUERIES)
    assert QUERIES.items() <= entry.queries().items() and CHECKS.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(cols, cur.fetchall())


def test_no_query_plans_a_product_of_two_tables(spark):
    for name in ("active_intervals", "mart_workforce", "as_of_join", "candidate_bridge", "mart_funnel", "q01", "q03"):
        text = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "date_day" and df.count() > 0


def test_contracts_store_no_daily_fact(monkeypatch):
    """The daily facts are read by one scan each; a stored copy would hold a row per employee and day."""
    stored = []
    monkeypatch.setattr(contracts, "cut_lineage", lambda df, name: stored.append(name))
    monkeypatch.setattr(contracts, "contract_report", lambda tables, declared: (set(tables), declared))
    tables, declared = contracts._contracts({m: mock.MagicMock() for m in contracts.CORE_CONTRACTS}, None, None)
    assert tables == set(declared) == set(contracts.CORE_CONTRACTS)
    assert set(stored) == set(contracts.CORE_CONTRACTS) - {"fact_headcount_snapshot_daily", "fact_manager_chain_daily"}
