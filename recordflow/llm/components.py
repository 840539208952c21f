"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import staged

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), the component being its smallest node.

    Large-star and small-star rounds in turn: each node's larger neighbours, then its smaller
    ones, are tied to its smallest neighbour, until nothing changes. That takes about as many
    rounds as the logarithm of the longest path. Each round's edges are staged, so a lost executor costs a re-read.
    """
    current = staged(oriented(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state[0] == 0 or state == before:
            break
        before = state
        both = current.union(current.select("v", "u"))
        # A table, so that the join of a node with very many neighbours can be split.
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "edges-least")
        large = both.join(least, F.col("u") == F.col("k")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(oriented(large), "edges")
        # Now u > v: each u ties all its smaller neighbours, and itself, to the smallest of them.
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k"), "edges-least")
        small = large.join(least, F.col("u") == F.col("k")).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        current = staged(oriented(small), "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).groupBy("node").agg(F.min("component").alias("component"))


def oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node to its smaller one, without loops."""
    return edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
