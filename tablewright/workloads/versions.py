"""Fingerprints and versioned tables."""

from pyspark.sql import functions as F

from tablewright.operators.versions import VersionedTable, diff, fingerprint
from tablewright.workloads.base import query, table


@query(
    "fingerprint",
    "SELECT count(*) AS n_rows, true AS same_after_shuffle, true AS changed_by_copy FROM lineitem",
)
def fingerprints(spark, sf):
    """The mark does not change with the row order, and does with the content."""
    rows = table(spark, sf, "lineitem")
    cases = {"plain": rows, "moved": rows.repartition(7, "l_suppkey"), "copied": rows.union(rows)}
    marks = None
    for name, df in cases.items():
        mark = fingerprint(df).select(F.lit(name).alias("name"), "n_rows", "fingerprint")
        marks = mark if marks is None else marks.union(mark)
    of = {name: F.max(F.when(F.col("name") == name, F.col("fingerprint"))) for name in cases}
    return marks.agg(
        F.max(F.when(F.col("name") == "plain", F.col("n_rows"))).alias("n_rows"),
        (of["plain"] == of["moved"]).alias("same_after_shuffle"),
        (of["plain"] != of["copied"]).alias("changed_by_copy"),
    )


@query("fingerprint_value")
def fingerprint_value(spark, sf):
    return fingerprint(table(spark, sf, "lineitem"))


def two_versions(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    stored = VersionedTable(spark).create(orders.where("o_orderkey % 10 <> 0"), "first")
    changed = orders.where("o_orderkey % 10 <> 1").withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    )
    stored.write(changed, "second")
    return stored


@query(
    "snapshot_write",
    """
    SELECT CAST(1 AS BIGINT) AS version, count(*) FILTER (o_orderkey % 10 <> 0) AS n_rows, 'first' AS note FROM orders
    UNION ALL SELECT 2, count(*) FILTER (o_orderkey % 10 <> 1), 'second' FROM orders
    """,
)
def snapshot_write(spark, sf):
    return two_versions(spark, sf).history().select("version", "n_rows", "note")


@query(
    "snapshot_read",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0",
)
def snapshot_read(spark, sf):
    return two_versions(spark, sf).read(1)


@query(
    "snapshot_revert",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0",
)
def snapshot_revert(spark, sf):
    stored = two_versions(spark, sf)
    stored.revert(1)
    return stored.read()


@query(
    "snapshot_diff_nulls",
    "SELECT o_orderkey, 'changed' AS change FROM orders WHERE o_orderkey % 3 = 0",
)
def snapshot_diff_nulls(spark, sf):
    """A value moves from one missing column to another."""
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey AS a", "CAST(NULL AS BIGINT) AS b")
    moved = orders.selectExpr(
        "o_orderkey", "IF(o_orderkey % 3 = 0, NULL, a) AS a", "IF(o_orderkey % 3 = 0, a, NULL) AS b"
    )
    return diff(orders, moved, ["o_orderkey"])


@query(
    "snapshot_read_mark",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0",
)
def snapshot_read_mark(spark, sf):
    """A version found by the fingerprint of its content."""
    stored = two_versions(spark, sf)
    return stored.read_mark(stored.entry(1)["fingerprint"])


@query(
    "snapshot_diff",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'added' WHEN o_orderkey % 10 = 1 THEN 'removed'
      ELSE 'changed' END AS change
    FROM orders WHERE o_orderkey % 10 IN (0, 1) OR o_orderstatus = 'P'
    """,
)
def snapshot_diff(spark, sf):
    stored = two_versions(spark, sf)
    return diff(stored.read(1), stored.read(2), ["o_orderkey"])
