"""Every registered query beside its SQL, on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    check_plan(name, plan_of(df))
    if name in SQL:
        assert difference(df, db, SQL[name]) is None
    else:
        assert len(df.collect()) > 0


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_is_the_top_ten(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["n"] >= rows[-1]["n"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["filter_gt"](spark, FOLDER))
    assert "GreaterThan(c_acctbal,21.0)" in plan
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>", plan)


def test_top_ten_keeps_k_rows_per_task(spark):
    plan = plan_of(entry.queries()["word_count_top10"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan
    assert "text:string>" in plan


def test_series_windows_work_within_chunks(spark):
    plan = plan_of(entry.queries()["ts_features"](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def check_plan(name, plan):
    """No pairing of all rows with all rows, and no row-wise Python."""
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
