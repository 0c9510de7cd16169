"""Connected components of a table of edges, by alternating stars.

A large star moves the neighbours above a node to its smallest neighbour, a small star those
below it. Edges only ever move down, so they end as one star per component. Each step is an
aggregation and a join on the node; a node that holds many edges is pre-aggregated before the
shuffle and its join partition is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.plans.materialize import materialize


def _state(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _smallest(edges: DataFrame) -> DataFrame:
    return materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "smallest")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; a component is its least node."""
    edges = materialize(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _smallest(both).withColumn("m", F.least("a", "m"))
        large = materialize(
            both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct(), "large")
        low = _smallest(large)
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*").filter("a <> b").distinct()
        edges = materialize(small, "edges")
        new = _state(edges)
        if new == state:
            break
        state = new
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b").distinct())
