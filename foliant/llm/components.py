"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import durable


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (u, v); component is the smallest node.

    Only minima are gathered for a node, so a node may have any number of neighbours; the
    number of rounds grows with the logarithm of the longest chain.
    """
    e = durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = durable(small.where("u <> v").distinct())
        before, state = state, _state(e)
        if state == before:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
