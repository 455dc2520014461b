"""Custody chains: the moves of a batch linked from node to node.

A move follows the one move of its batch that arrived where it departs. Arrivals and departures are counted by batch and
node, never paired, so many moves over the same node cost no more than others. Each move then points at the one it
follows, and pointers are doubled: after k rounds a move knows the one up to 2^k before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.session import materialise

START, GAP, MERGE, LINK = "start", "gap", "merge", "link"


def linked(moves: DataFrame, batch: str, move: str, from_node: str, to_node: str) -> DataFrame:
    """``batch``, ``move``, ``follows`` (the move before, if there is exactly one), ``kind`` and ``n_next``.

    ``kind`` is ``start`` for a move from nowhere, ``gap`` if nothing arrived where it departs, ``merge`` if several
    moves did, else ``link``. ``n_next`` counts the moves that depart where it arrives: more than one is a fork. A move is
    known by batch and ``move``, which are unique and not null.
    """
    rows = moves.select(F.col(batch).alias("batch"), F.col(move).alias("move"), F.col(from_node).alias("_from"), F.col(to_node).alias("_to"))
    count = F.count(F.lit(1))
    arrived = rows.groupBy("batch", F.col("_to").alias("_from")).agg(count.alias("n_before"), F.min("move").alias("_before"))
    departed = rows.groupBy("batch", F.col("_from").alias("_to")).agg(count.alias("n_next"))
    arrived, departed = materialise(arrived, "arrivals"), materialise(departed, "departures")
    n = F.coalesce("n_before", F.lit(0))
    kind = F.when(F.col("_from").isNull(), START).when(n == 0, GAP).when(n > 1, MERGE).otherwise(LINK)
    return (
        rows.join(arrived, ["batch", "_from"], "left")
        .join(departed, ["batch", "_to"], "left")
        .select("batch", "move", F.when(kind == LINK, F.col("_before")).alias("follows"), kind.alias("kind"), F.coalesce("n_next", F.lit(0)).alias("n_next"))
    )


def chains(moves: DataFrame, batch: str, move: str, from_node: str, to_node: str) -> DataFrame:
    """:func:`linked` with ``first`` (the move its chain begins with), ``place`` (0 for that one) and ``in_cycle``.

    A move that follows itself, directly or over others, or that follows such a move, is in a cycle and has no first
    one. Rounds end when no move is open, or when a round closed none: what is open then has no beginning.
    """
    rows = materialise(linked(moves, batch, move, from_node, to_node), "links")
    link = F.col("follows").isNotNull()
    at = rows.select("batch", "move", F.coalesce("follows", "move").alias("first"), link.cast("bigint").alias("place"), link.alias("open"))
    at, before = materialise(at, "pointers"), None
    while (open_ := at.where("open").count()) and open_ != before:
        above = at.select("batch", F.col("move").alias("first"), F.col("first").alias("_first"), F.col("place").alias("_place"), F.col("open").alias("_open"))
        # Only open pointers move; the others stay in place of a join.
        moved = at.where("open").join(above, ["batch", "first"]).select(
            "batch", "move", F.col("_first").alias("first"), (F.col("place") + F.col("_place")).alias("place"), F.col("_open").alias("open")
        )
        at, before = materialise(at.where("not open").unionByName(moved), "pointers"), open_
    closed = at.where("not open").select("batch", "move", "first", "place")
    return rows.join(closed, ["batch", "move"], "left").withColumn("in_cycle", F.col("first").isNull())


def chain_report(found: DataFrame) -> DataFrame:
    """Per batch: its moves, chains, gaps, merges, forks, moves in cycles, and the most moves of a chain's longest branch."""
    count = lambda condition, name: F.count_if(condition).alias(name)
    return found.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_moves"), count(F.col("place") == 0, "n_chains"), count(F.col("kind") == GAP, "n_gaps"),
        count(F.col("kind") == MERGE, "n_merges"), count(F.col("n_next") > 1, "n_forks"), count(F.col("in_cycle"), "n_in_cycles"),
        (F.coalesce(F.max("place"), F.lit(-1)) + 1).alias("longest"),
    )
