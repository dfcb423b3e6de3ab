"""Registered operators beside their SQL on the smallest tables, and plans without forbidden nodes."""

import duckdb
import pytest
from compare import compare, connect

import __spark_entry__ as contract
from tablesync.llm.registered import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF) == ""


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_distributed(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, name


def test_mix_equals_sql_on_odd_rows(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, "op10_curriculum_mix", str(tmp_path)) == ""
