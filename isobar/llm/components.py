"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.store import discard, written


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to ``(id, component)``, the smallest id reachable; ids without a link are absent.

    Alternating large and small stars: each round points every node's larger
    neighbours, then its smaller ones, at the smallest neighbour known.  Each
    round is a grouped minimum (combined before the shuffle) and an equi-join
    that adaptive execution can split on a hub.  Ends when a round changes
    nothing; the number of rounds grows with the logarithm of the size.  A
    round's table is deleted when the next one is there.  An empty link table
    gives an empty result.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        last, edges = edges, written(small.where("u > v").distinct())
        discard(last)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(now):
            break
        before = tuple(now)
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
