"""Connected components of a graph whose links are rows, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Links that a task of a round takes on average.
_LINKS_A_TASK = 200_000


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component) for each node of `links` (left, right: long), component being the
    smallest node that it reaches.

    In each round, every node is linked to the smallest node of its neighbourhood instead of to
    its neighbours: first its larger neighbours (large star), then its smaller ones
    (small star). The rows never grow beyond the number of links, and the rounds with the logarithm of
    the longest path. Neighbourhoods are aggregated, never gathered; links of a hot node are
    joined with one row, which adaptive execution splits. A round has tasks for its links, not for the session's
    partitions: each task of each shuffle writes files of its own, and there are many shuffles.
    """
    stars = checkpointed(
        links.where("left is not null and right is not null and left <> right")
        .select(F.greatest("left", "right").alias("node"), F.least("left", "right").alias("root")).distinct())
    tasks = 1 + stars.count() // _LINKS_A_TASK
    stars = stars.coalesce(tasks)
    for _ in range(most_rounds):
        if _is_settled(stars):
            break
        both = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        smallest = stars.groupBy("node").agg(F.min("root").alias("least"))
        least = both.select("node").distinct().join(smallest, "node", "left").select(
            "node", F.least("node", F.coalesce("least", "node")).alias("least"))
        large = (both.where("root > node").join(least, "node")
                 .select(F.col("root").alias("node"), F.col("least").alias("root")).coalesce(tasks).distinct().coalesce(tasks))
        lowest = large.groupBy("node").agg(F.min("root").alias("least"))
        small = (large.join(lowest, "node")
                 .select(F.when(F.col("root") == F.col("least"), F.col("node")).otherwise(F.col("root")).alias("node"),
                         F.col("least").alias("root")).where("node <> root").coalesce(tasks).distinct())
        stars = checkpointed(small.coalesce(tasks))
    else:
        raise RuntimeError(f"components: not settled in {most_rounds} rounds")
    roots = stars.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct()
    return stars.select("node", F.col("root").alias("component")).unionByName(roots)


def _is_settled(stars: DataFrame) -> bool:
    """Whether every node has one root and no root has one itself."""
    if not stars.groupBy("node").count().where("count > 1").isEmpty():
        return False
    return stars.select(F.col("root").alias("node")).distinct().join(
        stars.select("node"), "node", "left_semi").isEmpty()
