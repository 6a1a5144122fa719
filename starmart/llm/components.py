"""Connected components by alternating large and small stars.

A large star hangs the greater neighbours of every node on its smallest neighbour, a small star the
smaller ones; after a few rounds every node hangs on the smallest of its component. Each round is
written to the shared folder, which cuts the lineage, so lost executors cost one round at most. The
minima are written before they are joined: the join is then one between two plain shuffles, whose hot
partitions (the edges of one node with very many) Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import forget, stored


def _least(edges: DataFrame) -> DataFrame:
    """``m``, the smallest of u and its neighbours, for every u."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return stored(least.select("u", F.least("u", "least").alias("m")), "least")


def _round(edges: DataFrame) -> DataFrame:
    """A large and a small star."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large_least = _least(both)
    large = both.join(large_least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = stored(large.distinct(), "large")
    small_least = _least(large)
    ends = F.array(F.col("u"), F.col("v"))
    small = large.join(small_least, "u").select(F.explode(ends).alias("u"), F.col("m").alias("v"))
    small = stored(small.filter("u != v").distinct(), "edges")
    forget(large_least, large, small_least)
    return small


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("a"), F.sum(mark % 1_000_003).alias("b"))
    return tuple(row.first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node on an edge; the component is its smallest node.

    ``edges`` has two columns of one ordered type. Null ends and loops are left out.
    """
    u, v = edges.columns
    edges = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u != v").distinct()
    edges = stored(edges, "edges")
    state = _state(edges)
    while state[0]:
        old, edges = edges, _round(edges)
        forget(old)
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
