"""Connected components by alternating stars, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movrec.llm.common import settle


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """``(id, component)`` for every id in ``edges``: the least id reachable.

    Each round points every neighbour that is larger than a vertex to the
    least neighbour (large star), then every smaller one (small star), until
    the edge set no longer changes; then it is a forest of stars.  Minima are
    partial aggregates and each join meets a materialised table of minima, so
    the vertex of a huge star is split by the skewed-join rule and its edges
    are never gathered.
    """
    now = settle(
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    mark = _fingerprint(now)
    while mark[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = settle(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        least = settle(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(least, "hi").filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = settle(small.union(least.select("hi", "m")).distinct())
        last, mark = mark, _fingerprint(now)
        if last == mark:
            break
    ends = now.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return ends.union(now.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())


def _fingerprint(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("lo", "hi"))).first()
    return tuple(row)
