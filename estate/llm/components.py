"""Connected components of a link table, by alternating large and small stars.

Every round is a grouped minimum (combined before it shuffles) joined back to
the links, so neither a node with very many links nor a long chain ends up in
one task.  Links stay on the executors; each round is written to the shared
folder, and only whether all is settled reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm._ship import release, stored


def _stars(links: DataFrame) -> DataFrame:
    """Large star, then small star; links are ``(node, least)``, node > least."""
    both = links.unionByName(links.select(F.col("least").alias("node"), F.col("node").alias("least")))
    m = both.groupBy("node").agg(F.min("least").alias("m")).select("node", F.least("node", "m").alias("m"))
    large = (both.join(m, "node").filter(F.col("least") > F.col("node"))
             .select(F.col("least").alias("node"), F.col("m").alias("least")).distinct())
    m = large.groupBy("node").agg(F.min("least").alias("m"))
    small = large.join(m, "node")
    moved = small.filter(F.col("least") != F.col("m")).select(F.col("least").alias("node"), F.col("m").alias("least"))
    return moved.unionByName(m.select("node", F.col("m").alias("least"))).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether all links are stars: every node linked once, and no centre to
    another one (one grouped pass, no join)."""
    seen = links.select("node", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("least").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    both = seen.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return both.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``: the least node that it
    reaches.  Self links and repeated links are allowed; null ends are not."""
    now = stored(links.filter(F.col(a) != F.col(b))
                 .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("least")).distinct(), "links")
    while not _settled(now):
        now = stored(_stars(now), "links")
        release(links.sparkSession)
    return (now.select("node", F.col("least").alias("component"))
            .unionByName(now.select(F.col("least").alias("node"), F.col("least").alias("component")).distinct()))


def extended(known: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``known`` (``node, component``) after further links, which are first
    contracted to links between its components."""
    ends = links.select(a, b)
    for c in (a, b):
        ends = (ends.join(known.select(F.col("node").alias(c), F.col("component").alias("_c")), c, "left")
                .withColumn(c, F.coalesce("_c", c)).drop("_c"))
    merged = stored(components(ends, a, b).select(F.col("node").alias("component"), F.col("component").alias("_c")), "links")
    old = known.join(merged, "component", "left").select("node", F.coalesce("_c", "component").alias("component"))
    new = merged.select(F.col("component").alias("node"), F.col("_c").alias("component")).join(known.select("node"), "node", "left_anti")
    return old.unionByName(new)
