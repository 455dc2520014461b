"""Reconciliation of a source with its copy by row count and checksum."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.names import sql_name, sql_text
from dimflow.functions.rowhash import digest_halves, fold, row_text, strict_fold


@dataclass(frozen=True)
class Pair:
    """A source table and the copy it is compared with; None where there is none yet, which fails its checks."""

    table: str
    source: DataFrame
    target: DataFrame | None


def fingerprint(df: DataFrame, strict: bool = False) -> DataFrame:
    """One row: ``row_count`` and the order-independent ``row_hash``, from one pass over the table."""
    hi, lo = digest_halves(row_text(df.schema, strict))
    return df.select(hi.alias("_hi"), lo.alias("_lo")).agg(
        F.count(F.lit(1)).alias("row_count"),
        (strict_fold if strict else fold)([F.col("_hi"), F.col("_lo")]).alias("row_hash"),
    )


def compare(pairs: list[Pair], strict: bool = False) -> DataFrame:
    """Two rows per table, ``row_count`` and ``row_hash``, with both values and whether they agree.

    Each side is reduced to one row before the sides meet. Columns are hashed in the source's order.
    """
    sides = [
        fingerprint(df.select(*map(sql_name, pair.source.columns)), strict).selectExpr(
            f"{sql_text(pair.table)} as table_name",
            f"'{side}' as side",
            "inline(array(struct('row_count' as check_type, cast(row_count as string) as value), "
            "struct('row_hash' as check_type, row_hash as value)))",
        )
        for pair in pairs
        for side, df in (("source", pair.source), ("target", pair.target))
        if df is not None
    ]
    value = {s: F.max(F.when(F.col("side") == s, F.col("value"))) for s in ("source", "target")}
    return (
        reduce(DataFrame.unionByName, sides)
        .groupBy("table_name", "check_type")
        .agg(value["source"].alias("source_value"), value["target"].alias("target_value"))
        .withColumn("passed", F.col("source_value").eqNullSafe(F.col("target_value")))
    )


def report(pairs: list[Pair], run_id: str, strict: bool = False) -> DataFrame:
    """:func:`compare` in the form the audit keeps."""
    return compare(pairs, strict).select(
        F.lit(run_id).alias("run_id"),
        "table_name",
        "check_type",
        "source_value",
        "target_value",
        "passed",
        F.localtimestamp().alias("checked_at"),
    )


def all_passed(checks: DataFrame) -> DataFrame:
    """One row: did every check pass."""
    return checks.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"))
