"""Connected components of an edge table, without collecting it.

Alternating large-star and small-star rounds: in each, nodes hand their
neighbours the smallest node that they know, until nothing changes.  Every
round is written to the shared folder, which cuts the lineage.  The number of
rounds grows with the logarithm of the longest path.  A node with very many
neighbours is split by ``aggregated_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from relq.operators.joins import aggregated_join

from .staging import staged


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest v of its u."""
    return aggregated_join(pairs, pairs.groupBy("u").agg(F.min("v").alias("m")), "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges(u, v)``, component being the
    smallest reachable node.  Nodes are non-null longs; loops are ignored."""
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    state = _checksum(now)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _smallest(large).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        now = staged(small, "edges")
        if (new := _checksum(now)) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = new
