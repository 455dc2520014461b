"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.session import materialise


def components(links: DataFrame) -> DataFrame:
    """Rows ``node, component`` for every node of ``links`` (columns ``a``, ``b``); the component is its least node.

    Each round hangs every node on its least neighbour, follows that once more, and contracts the links
    to what is left, so a star of any size is gone after two rounds and links only get fewer. All
    intermediate tables are written to the shared folder: a lost executor costs a re-read, and joins on
    a node with very many links start from plain shuffles, which Spark can split. Loops and repeated
    links do no harm; without links the result is empty. Nulls belong to no link.
    """
    edges = materialise(_tidy(links.select("a", "b")), "links")
    labels = None
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialise(ends.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("up")), "parents")
        above = parents.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        parents = materialise(parents.join(above, "up").select("node", F.col("upper").alias("up")), "parents")
        if labels is None:
            labels = parents.withColumnRenamed("up", "component")
        else:
            step = parents.withColumnRenamed("node", "component")
            labels = labels.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        labels = materialise(labels, "labels")
        for end in ("a", "b"):
            step = parents.select(F.col("node").alias(end), F.col("up").alias("_up"))
            edges = edges.join(step, end).drop(end).withColumnRenamed("_up", end)
        edges = materialise(_tidy(edges), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) if labels is None else labels


def _tidy(links: DataFrame) -> DataFrame:
    lower, upper = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return links.where("a <> b").select(lower, upper).distinct()
