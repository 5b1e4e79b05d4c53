"""Connected components by large-star and small-star rounds, without gathering a neighbourhood anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import cut


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a, b) of longs to (node, root): root is the smallest node reachable. Loops and repeats do no harm.

    Each half-round needs only the minimum of a node's neighbours (an aggregate with partial sums) and
    a join back to it (which Spark can split where a node has very many edges).
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        if large:
            out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    was = None
    for _ in range(most_rounds):
        e = cut(star(star(e, True), False))
        now = e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == was:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        was = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
