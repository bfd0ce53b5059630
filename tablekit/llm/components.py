"""Connected components by alternating large and small stars.

Each round replaces edges by edges to smaller neighbours until all edges point at
the smallest node of their component; the number of rounds grows with the
logarithm of a component's size. Edges are rows of a written table throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.scratch import written


def _with_least(edges: DataFrame) -> DataFrame:
    """``(u, v, m)``: m is the smallest of u and its neighbours."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("least"))
    return edges.join(least, F.col("u") == F.col("w")).select("u", "v", F.least("u", "least").alias("m"))


def _canonical(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``; the component is its smallest node."""
    edges = written(_canonical(edges), "components-edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(_canonical(large), "components-large")
        met = _with_least(large)
        small = met.select("u", F.col("m").alias("v")).unionByName(met.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = written(_canonical(small), "components-small")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
