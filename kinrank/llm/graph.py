"""Connected components over a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the undirected edges ``a, b`` (bigint):
    the smallest node that can be reached.

    Alternating large and small stars (Kiveris et al., "Connected Components
    in MapReduce and Beyond"): each round is two aggregates and joins over the
    edges, written to the shared folder; the number of rounds grows with the
    logarithm of the longest path. Smallest neighbours come from partial
    aggregates, and the joins back to a popular node can be split.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        # every edge of ``large`` points from a larger to a smaller node
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        now = written(small, "edges")
    raise RuntimeError(f"no end after {max_rounds} rounds")
