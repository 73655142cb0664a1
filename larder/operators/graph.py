"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import discard, materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links`` but the smallest of its component.

    Two alternating steps shorten all ways to the smallest node: the larger
    neighbours of a node are linked to its smallest neighbour, then the smaller
    ones are. The links that remain form stars around the smallest nodes. A
    smallest neighbour is a minimum, combined before its shuffle, so a hub is no
    single task's list; each round is a stored table, and nothing is collected
    but the count of changed links.
    """
    def stars(table: DataFrame, larger: bool) -> DataFrame:
        """Links (a > b) after one step."""
        if larger:
            both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
            moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            low = table.groupBy("a").agg(F.min("b").alias("low"))
            moved = table.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
                low.withColumnRenamed("low", "b"))
        return moved.where("a > b").distinct()

    pair = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    now = materialize(pair.where("a > b").distinct(), "links")
    while True:
        wide = materialize(stars(now, larger=True), "links")
        new = materialize(stars(wide, larger=False), "links")
        same = new.join(now, ["a", "b"], "left_anti").isEmpty() and now.join(new, ["a", "b"], "left_anti").isEmpty()
        discard(now, wide)
        now = new
        if same:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
