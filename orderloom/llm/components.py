"""Connected components of a table of links, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, component: the nodes of the links (a, b) and the node that stands for their component.

    Each round, every node that is left moves to its least neighbour if that is less than itself, and links
    are carried over to where their ends have moved; a link whose ends meet is done. Nodes are hashes,
    so the number of those left falls by a constant factor a round, stars are done in one. A node with very
    many links is reduced to one row a task before it is dealt out, and the joins that carry links have
    one row for a node on their other side, so Spark may split them.
    """
    left = links.where("a <> b").select("a", "b").distinct()
    both = written(left.union(left.select("b", "a")), "links")
    labels = None
    while not both.isEmpty():
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        moved = written(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "moves")
        if labels is None:
            labels = moved.withColumnRenamed("to", "component")
        else:
            labels = written(
                labels.join(moved, labels["component"] == moved["node"], "left").select(
                    labels["node"], F.coalesce(moved["to"], labels["component"]).alias("component")
                ),
                "labels",
            )
        tails = moved.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        heads = moved.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        both = written(
            both.join(tails, "a")
            .join(heads, "b")
            .select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
            .where("a <> b")
            .distinct(),
            "links",
        )
    if labels is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
