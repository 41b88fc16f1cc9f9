"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import checkpointed, join_counted


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node of ``edges`` (a, b).

    Alternating large and small stars: every node hands its larger (then its
    smaller) neighbours to the least one around, until nothing changes. Each
    round is a grouped minimum and a join on the node, whose hot nodes (centres
    of large stars) are joined by broadcast; rounds are cut by checkpoints."""
    now = checkpointed(edges.filter(F.col("a") != F.col("b"))
                       .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        large = join_counted(both, least, "a", "n", 2 * state[0])
        large = large.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        # small stars: a is the larger end of each edge
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = join_counted(large, least, "a", "n", state[0])
        now = checkpointed(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                           .unionByName(small.select("a", F.col("m").alias("b")))
                           .filter(F.col("a") != F.col("b")).distinct())
