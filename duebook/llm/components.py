"""Connected components by alternating star steps, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.rows import pinned


def _to_least(links: DataFrame, upward: bool) -> DataFrame:
    """Link each node's neighbours to its least one: larger neighbours, or those not larger."""
    if upward:
        seen = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = seen.join(least, "a")
    out = joined.where(F.col("b") > F.col("a")) if upward else joined.where(F.col("b") != F.col("least"))
    to_least = out.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not upward:
        own = least.where("a != least").select("a", F.col("least").alias("b"))
        to_least = to_least.union(own)
    return to_least.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (b < a): each linked node and the least node it can reach; least nodes left out.

    ``links``: columns ``a, b`` of one orderable type, no nulls. Each round writes its links to the
    shared folder; their number does not grow, and rounds stop when every node points to its root.
    A hub's neighbours are joined, not gathered: skewed joins are split by the planner.
    """
    current = pinned(links.select("a", "b").where("a != b").distinct())
    while True:
        current = pinned(_to_least(_to_least(current, upward=True), upward=False))
        # Done when no node is both a root and a child: then every link leads to a root.
        parents = current.select(F.col("b").alias("a")).distinct()
        if current.join(parents, "a", "left_semi").isEmpty():
            doubled = current.groupBy("a").count().where("count > 1")
            if doubled.isEmpty():
                return current
