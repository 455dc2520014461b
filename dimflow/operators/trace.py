"""Weekly batches: their assembly, the links to what went into them, and their balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.calendar import batch_id
from dimflow.session import materialise


def assemble(transactions: DataFrame, node: str, at: str, quantity: str) -> DataFrame:
    """One row per node and Monday-to-Sunday week: the total quantity and the last transaction.

    The quantity should be a decimal: its sum is then exact and independent of order. Groups are told
    apart by node and Monday; the identifier is made afterwards, once per batch.
    """
    return (
        transactions.groupBy(F.col(node), F.trunc(at, "week").alias("_monday"))
        .agg(F.sum(quantity).alias("total_quantity"), F.max(at).alias("last_transaction_at"))
        .select(batch_id(node, "_monday").alias("batch_id"), node, "total_quantity", "last_transaction_at")
    )


def links(transactions: DataFrame, node: str, at: str, quantity: str, transaction_id: str) -> DataFrame:
    """One row per transaction with the batch it went into. A projection; nothing is shuffled."""
    return transactions.select(
        batch_id(node, at).alias("batch_id"),
        F.col(transaction_id).alias("transaction_id"),
        F.col(quantity).alias("quantity_allocated"),
        F.col(at).alias("updated_at"),
    )


def last_event(events: DataFrame, at: str, event_id: str) -> DataFrame:
    """The last event of each batch, ties going to the greater id."""
    rest = [c for c in events.columns if c not in ("batch_id", at, event_id)]
    row = F.max(F.struct(at, event_id, *rest)).alias("_last")
    return events.groupBy("batch_id").agg(row).select("batch_id", "_last.*")


def trace(
    batch_links: DataFrame,
    transactions: DataFrame,
    transaction_id: str,
    events: DataFrame,
    at: str,
    event_id: str,
) -> DataFrame:
    """Every lot of every batch, with its transaction and the last event of its batch.

    ``traced`` tells whether both ends were found. Links without either are kept.
    """
    # Written first, so that the join below starts from two plain shuffles and a hot batch can be split.
    ends = materialise(last_event(events, at, event_id), "last-events")
    lots = transactions.withColumn("_lot", F.col(transaction_id)).drop(transaction_id)
    return (
        batch_links.join(lots, batch_links["transaction_id"] == F.col("_lot"), "left")
        .join(ends, "batch_id", "left")
        .withColumn("traced", F.col("_lot").isNotNull() & F.col(event_id).isNotNull())
        .drop("_lot")
    )


def mass_balance(batch_links: DataFrame, events: DataFrame, quantity: str) -> DataFrame:
    """Per batch, what was allocated and what its events carry; balanced when all of it agrees.

    Both sides are reduced to a row per batch before they meet; a batch on one side only is kept and
    is not balanced.
    """
    allocated = batch_links.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_lots"), F.sum("quantity_allocated").alias("allocated")
    )
    carried = events.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min(quantity).alias("least_carried"),
        F.max(quantity).alias("most_carried"),
    )
    agree = (F.col("least_carried") == F.col("allocated")) & (F.col("most_carried") == F.col("allocated"))
    return (
        allocated.join(carried, "batch_id", "full")
        .withColumn("n_lots", F.coalesce("n_lots", F.lit(0)))
        .withColumn("n_events", F.coalesce("n_events", F.lit(0)))
        .withColumn("balanced", F.coalesce(agree, F.lit(False)))
    )
