"""Connected components of an undirected graph by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with an edge; the component is its smallest node.

    Each round is two grouped minima (combined map-side) and two joins back, and the number of edges never grows. The
    loop ends when a round changes nothing; RuntimeError if that takes more than ``max_rounds``. Self loops, repeated edges and nulls are ignored.
    """
    x, y = F.col(a), F.col(b)
    e = cut(edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    mark = _mark(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        e = cut(small.distinct())
        before, mark = mark, _mark(e)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components aren't settled after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(u, v))"), F.lit(0))).first())
