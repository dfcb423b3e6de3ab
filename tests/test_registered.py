"""Every registered query beside its SQL, and what the plans must not contain."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from tablesync.plans.oracle import ORACLE
from tablesync.plans.registered import REGISTERED

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(REGISTERED) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(REGISTERED))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF) == ""


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 12 and all(r.mobile_number.startswith("138****") for r in rows)


# Queries that write tables of their own, whose runs are looked at in the tests of their operators.
WRITE = ("cdc_stream", "cdc_apply", "cdc_lookup", "cdc_replay", "sync_", "sql_", "backfill_merge", "backfill_repeat", "backfill_audit")
FREE = [n for n in REGISTERED if not n.startswith(WRITE)]


@pytest.mark.parametrize("name", FREE)
def test_plans_stay_distributed(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        assert bad not in plan, name


def test_latest_per_key_reduces_before_the_shuffle(spark):
    plan = contract.queries()["cdc_latest_per_key"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and plan.count("Exchange") == 1


def test_events_are_parsed_once(spark):
    for name in ("cdc_scope", "cdc_after_append", "cdc_quarantine"):
        plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == (2 if name == "cdc_after_append" else 1), name
