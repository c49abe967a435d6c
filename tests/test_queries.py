"""Every registered query beside its SQL, and what its plan must not hold."""

import importlib

import duckdb
import pytest

import __spark_entry__ as entry
from tablewright.workloads import ORACLES, QUERIES
from tools.check_queries import TABLES, canonical

SF = "/root/testdata/sf0.001"
# Checked by properties in their own tests, not by SQL.
NO_SQL = {
    "train_classifier", "score_batch", "counterfactual_search", "feature_attribution",
    "entity_key_only_predict", "drift_p_value", "fingerprint_value",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"train_classifier"}))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert mine[1]
        return
    cur = duck.execute(ORACLES[name])
    assert mine == canonical([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["p_name", "popularity"] and out.count() == 10
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_period_filter_reaches_the_scan(spark):
    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_package_layout():
    for name in ("operators", "sources", "functions", "plans", "streaming"):
        importlib.import_module(f"tablewright.{name}")
