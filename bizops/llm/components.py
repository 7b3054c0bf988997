"""Connected components of a link table by joins and minima, for any shape of graph.

Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
neighbours ("large star"), then to its smaller ones ("small star").  Each step keeps the
components, never makes more than one row per link, and needs only a minimum per node (summed on
the map side) and one join on the node, whose hot partitions Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizops.llm.scratch import Scratch


def _star(links: DataFrame) -> DataFrame:
    """For directed rows (u, v): the smallest of u and its v's, beside each v."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("_u"), F.least("u", "m").alias("m")
    )
    return links.join(least, F.col("u") == F.col("_u")).select("u", "v", "m")


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    ``links`` has columns ``u`` and ``v`` (bigint).  Rows with a null end or ``u = v``, repeated
    rows and either direction are all allowed; an empty table gives no rows.
    """
    spark = links.sparkSession
    both = links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    edges = scratch.table(
        both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        # large star: larger neighbours move to the least neighbour
        two_way = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(two_way).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: each node and its smaller neighbours move to the least of them
        stars = _star(large)
        edges = scratch.table(
            stars.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(stars.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct(),
            "links",
        )
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    # Stable: every edge leads from a node to its component's least node.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
