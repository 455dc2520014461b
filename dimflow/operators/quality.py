"""Duplicate-identity candidates. They are flagged for a person to review, never merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.session import materialise


def _shared(df: DataFrame, identity: str | Column, name: str, member: str) -> DataFrame:
    computed = not isinstance(identity, str)
    value = identity if computed else F.col(identity)
    rows = df.select(value.alias(name), F.col(member).cast("string").alias("_member")).where(
        F.col(name).isNotNull()
    )
    if computed:
        # Read twice below: the identity is made once, and what it is made of is read once.
        rows = materialise(rows, "identities")
    counts = (
        rows.groupBy(F.col(name).alias("_identity"))
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .where(F.col("occurrence_count") > 1)
    )
    # Written, as the join splits a hot identity only if both sides come straight from a shuffle.
    counts = materialise(counts, "shared-identities")
    return rows.join(counts, F.col(name) == F.col("_identity")).drop("_identity")


def duplicate_members(df: DataFrame, identity: str | Column, name: str, member: str) -> DataFrame:
    """One row per member of a group whose identity occurs more than once."""
    return _shared(df, identity, name, member).select(
        name, "occurrence_count", F.col("_member").alias("member")
    )


def duplicate_candidates(df: DataFrame, identity: str | Column, name: str) -> DataFrame:
    """Identities that occur more than once, one row each, with the count; NULL is not a shared identity.

    The members, one per row whatever the group's size, come from :func:`duplicate_members`.
    """
    value = (F.col(identity) if isinstance(identity, str) else identity).alias(name)
    groups = df.select(value).where(F.col(name).isNotNull()).groupBy(name)
    return groups.agg(F.count(F.lit(1)).alias("occurrence_count")).where(F.col("occurrence_count") > 1)


def review_order(candidates: DataFrame, name: str) -> DataFrame:
    """The candidates with the most frequent identity first."""
    return candidates.orderBy(F.col("occurrence_count").desc(), F.col(name))
