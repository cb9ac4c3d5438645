"""Connected components by alternating star contraction, as DataFrame jobs.

Each round joins every node's larger neighbours to its smallest one (large
star), then every node and its smaller neighbours to their smallest (small
star); the rounds needed grow with the logarithm of the nodes. Edges stay in
tables; only a count of changed edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.text import materialise


def _star(e: DataFrame, large: bool) -> DataFrame:
    # (u, v) rows; each u's smallest neighbour, itself included
    least = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    j = e.join(least, "u")
    if large:
        out = j.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge, root the smallest node it reaches."""
    e = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "cc")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialise(_star(both, True), "cc-large")
        small = materialise(_star(large, False), "cc-small")
        # done when every node hangs on one root, and no root hangs on anything
        parents = small.select(F.col("v").alias("u")).distinct()
        done = (small.join(parents, "u", "left_semi").isEmpty()
                and small.groupBy("u").count().filter("count > 1").isEmpty())
        e = small
        if done:
            break
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
