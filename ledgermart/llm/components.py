"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import scratch_table


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is its component's smallest node.

    Each step hangs nodes under their smallest neighbour, so a hub is one row per task after the
    partial minimum. Steps are written to the shared folder; the number of steps grows with the
    logarithm of the longest path. Both ends of a link come from one read of it, and the result is
    written too, so that the plans of its readers stay small on the driver.
    """
    edges = scratch_table(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        # large star: larger neighbours move under the smallest neighbour
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and the node move under the smallest of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch_table(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    rooted = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root"))))).distinct()
    return scratch_table(rooted, "components")
