"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog import workspace


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` to ``(node, root)``; the root is the smallest node of its component.

    Star contraction: every node passes its larger neighbours to its smallest
    one, then the smaller ones, until nothing changes. The number of links never
    grows, minima are combined before the shuffle, and each round is written to
    the shared folder, so a lost executor costs one round at most. Nodes without
    a link to another node do not appear.
    """
    now = workspace.materialize(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        ).distinct()
        now = workspace.materialize(small, "links")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
