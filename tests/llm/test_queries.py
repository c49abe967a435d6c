"""Every corpus query beside its SQL, and the contract of the entry module."""

import duckdb
import pytest

import __spark_entry__ as entry
from tablewright.llm import ORACLES, QUERIES
from tests.llm.conftest import SF
from tools.check_queries import TABLES, canonical


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLES[name])
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert mine == canonical([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", ["op5_sharding", "op10_mixing"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
