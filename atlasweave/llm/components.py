"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.llm.stored import stored


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) that is not its component's root.

    The root is the smallest node of the component. Each round hangs the larger
    neighbours of a node on its smallest one (large star), then does the same with the
    smaller neighbours (small star); the number of rounds grows with the logarithm of
    the longest path. Each round is a stored table, and a node with very many
    neighbours is split by adaptive execution, as both sides of its join are tables.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    sign = _signature(now)
    while sign[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = stored(small.unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        new_sign = _signature(new)
        if new_sign == sign:
            break
        now, sign = new, new_sign
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
