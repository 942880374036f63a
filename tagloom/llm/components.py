"""Connected components of a table of links by alternating stars, staged in the shared folder after every round.

A round links every node's larger neighbours to its smallest one (large star), then its smaller neighbours and itself
to the smallest (small star). Both are a minimum per node, which Spark combines before it shuffles, and a join whose
hot side is split at run time; no task or driver ever holds the neighbours of one node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.sizing import staged

MAX_ROUNDS = 60


def _star(directed: DataFrame, keep) -> DataFrame:
    """For each node ``u`` of ``directed``, links from its neighbours ``v`` to its smallest neighbour or itself."""
    smallest = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = directed.join(smallest, "u").filter(keep)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, of every node in ``links`` (two columns of one type)."""
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = staged(edges, "links")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        large = large.filter("u <> v").distinct()
        lowered = _star(large, F.lit(True)).filter("u <> v")
        tops = large.groupBy("u").agg(F.min("v").alias("v"))
        edges = staged(lowered.unionByName(tops).distinct(), "links")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components didn't settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
