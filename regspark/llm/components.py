"""Connected components of an edge table by contraction along random orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a, b) -> (node, component), component the smallest node of those connected.

    In each round every node joins that neighbour (or itself) whose hash, by the round's number, is
    smallest; edges inside what has joined go. A chain in any order of ids thus shortens by a
    constant share of its nodes each round. Sums and minima are combined before the shuffle; a
    node with very many edges is met only in joins that adaptive execution can split."""
    left = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    steps = []
    for k in range(most_rounds):
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c, k=k: F.xxhash64(c, F.lit(k))
        near = both.groupBy("a").agg(F.min_by("b", order("b")).alias("near"))
        to = materialise(near.select(F.col("a").alias("node"), F.when(order("near") < order("a"), F.col("near")).otherwise(F.col("a")).alias("to")), "steps")
        steps.append(to)
        a, b = (to.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        left = materialise(left.join(a, "a").join(b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).filter("a <> b").distinct(), "edges")
    else:
        raise RuntimeError("the components did not settle")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def compose(first: DataFrame, then: DataFrame) -> DataFrame:
        after = then.select(F.col("node").alias("to"), F.col("to").alias("end"))
        return first.join(after, "to", "left").select("node", F.coalesce("end", "to").alias("to"))

    roots = materialise(reduce(compose, steps), "roots")
    least = materialise(roots.groupBy("to").agg(F.min("node").alias("component")), "least")
    return roots.join(least, "to").select("node", F.least("component", "to").alias("component"))
