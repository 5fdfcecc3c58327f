"""Connected components by alternating large and small stars on DataFrames.

Every round replaces the edge list by one that joins each node to smaller ones;
it ends when all edges are stars around the smallest node of their component.
The only state is the edge table, written to the shared folder each round.  A
node of very many edges costs one row in the aggregate (minimum per node, with
map-side partial sums) and a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import saved

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = (both.groupBy("src").agg(F.min("dst").alias("low"))
           .select("src", F.least("src", "low").alias("low")))
    return (both.filter(F.col("dst") > F.col("src")).join(low, "src")
            .select(F.col("dst").alias("src"), F.col("low").alias("dst")))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them.  Edges run
    from the larger to the smaller node here."""
    low = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = (edges.join(low, "src").filter(F.col("dst") != F.col("low"))
             .select(F.col("dst").alias("src"), F.col("low").alias("dst")))
    return moved.union(low.select("src", F.col("low").alias("dst"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (src, dst) of any orderable type -> (node, component): the
    smallest node reachable.  Nodes without an edge to another node are absent.
    NULL ends and self-loops are dropped; no rows give no rows."""
    current = saved(
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(),
        "edges")
    for _ in range(MAX_ROUNDS):
        # done when no node has two parents and no parent has a parent
        parents = current.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
        if not current.isEmpty():
            crowded = parents.filter(F.col("n") > 1).select("src").limit(1)
            chained = current.select("dst").join(
                current.select(F.col("src").alias("dst")), "dst", "left_semi").limit(1)
            if crowded.union(chained).isEmpty():
                break
        else:
            break
        current = saved(_small_star(_large_star(current)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
            .union(current.select("dst", "dst").distinct()))
