"""Connected components of links that may fill any number of machines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.sources.workspace import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the links (a, b); the component is its smallest node.

    Every node hands its smallest neighbour to the larger ones, then to the
    smaller ones and itself, until all point to the smallest node. Each step
    is a grouped minimum, which combines on the map side, and a join, whose
    hot keys adaptive execution splits. Steps are written to the shared
    folder; the driver sees a count and a checksum.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    state = None
    while True:
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = tuple(found)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
