"""Connected components of an edge table, as repeated star contractions on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import small, staged


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(a, b) -> (node, root): every node that has an edge, with the smallest node it is connected to.

    Alternates large-star and small-star steps; each step is a grouped minimum (combined map-side) and
    a join on the node, and is written to the shared folder. The minima are written before
    the join, so the edges of a node with very many are not gathered for it: the join broadcasts few minima or splits the skew. The work is linear in the edges and the
    number of steps logarithmic; it raises if ``limit`` steps do not settle (they never drop a link).
    """
    pair = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = staged(pair(edges), "components-edges")
    seen = None
    for _ in range(limit):
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = small(staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "components-low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(pair(large), "components-large")
        low = small(staged(large.groupBy("a").agg(F.min("b").alias("m")), "components-low"))
        stars = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        now = staged(pair(stars), "components-small")
    raise RuntimeError("components did not settle")
