"""Registry of runnable queries, each beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; without ``sql`` only its rows are checked."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__ = run.__qualname__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Money as whole cents and rates as whole percents: sums of whole numbers do
# not depend on the order of addition, so means can be compared exactly.
# ``rint`` is a machine instruction; ``round`` on a double goes through decimals.
LINE_FEATURES = ["quantity", "price_cents", "discount_pct", "tax_pct"]
LINE_SQL = (
    "SELECT l_partkey, l_suppkey, l_shipdate, l_returnflag, l_quantity AS quantity, "
    "round(l_extendedprice * 100) AS price_cents, round(l_discount * 100) AS discount_pct, "
    "round(l_tax * 100) AS tax_pct FROM lineitem"
)


def line_features(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        *extra,
        "l_quantity AS quantity",
        "rint(l_extendedprice * 100) AS price_cents",
        "rint(l_discount * 100) AS discount_pct",
        "rint(l_tax * 100) AS tax_pct",
    )
