"""Connected components over a table of links, by alternating large-star and small-star steps.

Links never reach the driver; each step is a minimum per node (combined before the shuffle) and a join whose two
sides are stored tables, so that adaptive execution can split a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.llm.scratch import store


def _size(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    ``rows`` is a bound on the number of links, if one is known.
    Nulls and self-links are no links.  An empty table gives an empty result.
    """
    x, y = F.least(a, b), F.greatest(a, b)
    edges = store(links.where(f"{a} is not null and {b} is not null and {a} <> {b}")
                  .select(y.alias("u"), x.alias("v")).distinct(), "cc-edges", rows)
    before = _size(edges)
    while before[0]:
        n = 2 * before[0]  # no step makes more links than there are, nor more nodes
        # large star: every larger neighbour of u is tied to u's smallest neighbour
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least", n)
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = store(large, "cc-large", n)
        # small star: the smaller neighbours of u, and u, are tied to the smallest of them
        least = store(large.groupBy("u").agg(F.min("v").alias("m")), "cc-small", n)
        down = large.join(least, "u")
        edges = store(down.select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "cc-edges", n)
        after = _size(edges)
        if after == before:
            break
        before = after
    tied = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return store(tied.union(roots.join(tied.select("node"), "node", "left_anti")), "components", 2 * before[0])
