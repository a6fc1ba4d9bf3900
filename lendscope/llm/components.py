"""Connected components of a link table, by alternating large-star and small-star.

Every round is a few joins and aggregations by node; the link table is written
to the shared folder each round, so the lineage stays short and a lost executor
costs one round. A node linked to very many others is aggregated map-side and
its join side is split by adaptive execution. Where there are few links, the
smallest neighbours are sent to every task and the links stay where they are: a
round then shuffles two aggregates and its result. Nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import LOOKUP_ROWS, lookup, staged


def _large_star(links: DataFrame, small: bool) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or
    itself): one row a link, repeats go in the small star."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(lookup(least, small), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame, small: bool) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = links.where(F.col("v") < F.col("u"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(lookup(least, small), "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v")).distinct())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; component is the smallest
    node reachable. ``links`` has two id columns without nulls; direction,
    repeats and self-links don't matter. The first round reads it several times,
    so it should be a written table."""
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v"))
    small = False
    while True:
        small = small or now.count() <= LOOKUP_ROWS  # no round adds links
        after = staged(_small_star(_large_star(now, small), small), "links")
        # done when each node points at one smaller node that points nowhere
        ends = after.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            after.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        if (ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
                .where("out > 1 OR (out = 1 AND into = 1)").isEmpty()):
            break
        now = after
    roots = after.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
