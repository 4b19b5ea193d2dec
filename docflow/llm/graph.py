"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import spread_join, staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Each round takes the least label around every node, hooks the label's own
    root to it, and jumps pointers, so rounds grow with the logarithm of a
    component's width in practice. A group's rows never meet in one task: all
    steps are minima and joins, that by a component's label spread where it is
    hot. Every round is staged in the shared folder.

    Defined results: edges that repeat, run either way or join a node to itself
    change nothing; a node without an edge to another, and an empty table, give
    no row. Nodes are not null.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    both = staged(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node"))
                    .agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("component")),
                    "labels")
    while True:
        around = (both.join(labels.withColumnRenamed("node", "b"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        known = labels.join(around, "node").select("node", "component", F.least("component", "near").alias("low"))
        hooked = (known.where("low < component").groupBy(F.col("component").alias("node"))
                  .agg(F.min("low").alias("hook")))
        low = (known.join(hooked, "node", "left")
               .select("node", "component", F.least("low", "hook").alias("low")))
        low = staged(low, "labels")
        counts = low.groupBy("low").agg(F.count("*").alias("n"))
        up = low.select(F.col("node").alias("low"), F.col("low").alias("up")).join(counts, "low")
        jumped = staged(spread_join(low, up, "low", ["node"]).select("node", F.least("low", "up").alias("component"),
                                                   F.col("component").alias("was")), "labels")
        if jumped.where("component != was").isEmpty():
            return jumped.select("node", "component")
        labels = jumped.select("node", "component")
