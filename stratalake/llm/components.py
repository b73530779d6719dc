"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node that can be reached. Self-links
    may occur.

    Each round hooks every node to its smallest neighbour, shortens the hooks to their ends by doubling, and
    replaces nodes by those ends; at least half of the nodes that still have links go. All steps are joins and
    minima over narrow rows, staged, so a hub with a third of all links is combined before it is shuffled and
    long chains take few rounds."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staged(both.where("a <> b").distinct(), "links")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = staged(nodes.withColumn("root", F.col("node")), "roots")
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        hooks = staged(hooks.select("node", F.least("node", "least").alias("to")), "hooks")
        while True:
            target = hooks.select(F.col("node").alias("to"), F.col("to").alias("end"))
            moved = (F.col("end") != F.col("to")).alias("moved")
            longer = staged(hooks.join(target, "to").select("node", F.col("end").alias("to"), moved), "hooks")
            hooks = longer.select("node", "to")
            if longer.where("moved").isEmpty():
                break
        end = hooks.select(F.col("node").alias("root"), F.col("to").alias("end"))
        roots = staged(roots.join(end, "root", "left").select("node", F.coalesce("end", "root").alias("root")), "roots")
        edges = edges.join(hooks.withColumnRenamed("node", "a").withColumnRenamed("to", "a2"), "a")
        edges = edges.join(hooks.withColumnRenamed("node", "b").withColumnRenamed("to", "b2"), "b")
        edges = staged(edges.where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "links")
    return roots
