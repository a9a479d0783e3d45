"""Connected components of a graph too large for one machine, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stage


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not the smallest of its component; root is the smallest node.

    Each round links every node to the least of its neighbours, first upwards, then downwards, until nothing changes; the number of
    rounds grows with the logarithm of the longest path. Rounds are written to the shared folder. The least neighbours are written
    before the join so that its sides are plain exchanges, of which adaptive execution splits a partition with a much linked node.
    An edge of a node with itself is left out; repeated edges count once; no edges give no rows.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(links, "links")
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if mark == seen or mark[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        links = stage(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct(), "links")
        least = stage(links.groupBy("a").agg(F.min("b").alias("m")), "least")
        down = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stage(down.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
