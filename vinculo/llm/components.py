"""Connected components on Spark: alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.session import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """The least node reachable from every linked node.

    ``links`` has columns ``u`` and ``v`` (comparable, no nulls); links of a node to itself are ignored. The result has
    ``node`` and ``component`` for each node that is not itself the least of its component. Each round is a written
    table, so a lost executor costs one round at most; the number of rounds grows with the logarithm of the longest
    chain. Nothing but two numbers per round reaches the driver.
    """
    now = staged(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        now = staged(_small_star(_large_star(now)), "links")
