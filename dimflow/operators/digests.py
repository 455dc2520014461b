"""Which rows of two copies of a table differ, found by digests of key ranges in two levels.

Each side is reduced, in one pass of its own, to a digest for each small range of keys (a leaf); leaves fold
into branches. Sides are compared branch by branch, then leaf by leaf within the branches that differ, then key by
key within the leaves that differ, so what meets grows with the differences and not with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.names import sql_name
from dimflow.functions.rowhash import digest_halves, row_text
from dimflow.session import materialise

CHANGED, MISSING, EXTRA = "changed", "missing", "extra"
#: Up to so many leaves are filters that reach the scan; more are joined.
MOST_LEAVES = 200
_SUMS = ["_n", "_hi", "_lo", "_hi_sum", "_lo_sum"]


@dataclass(frozen=True)
class Ranges:
    """How keys are cut into leaves, and how many leaves make a branch.

    With ``width`` the only key is an integer and a leaf is ``width`` successive values, so a leaf's rows can be
    asked for by a filter on the key. Without it keys of any kind fall into ``leaves`` leaves by their hash.
    """

    keys: tuple[str, ...]
    width: int | None = None
    leaves: int = 1 << 16
    fanout: int = 256

    def __post_init__(self) -> None:
        if self.width is not None and (len(self.keys) != 1 or self.width < 1):
            raise ValueError("leaves of successive values have one key and a positive width")

    def leaf(self) -> Column:
        """The leaf of a row; rows without a key have none."""
        if self.width is not None:
            return F.floor(F.col(sql_name(self.keys[0])) / F.lit(self.width)).cast("bigint")
        return F.pmod(F.xxhash64(*[F.col(sql_name(k)).cast("string") for k in self.keys]), F.lit(self.leaves))

    def branch(self) -> Column:
        return F.floor(F.col("_leaf") / F.lit(self.fanout)).cast("bigint")


def _digested(df: DataFrame, columns: list[str], by: dict[str, Column]) -> DataFrame:
    """Count, XOR and sum of the row digests of each group: equal rows do not cancel out."""
    rows = df.select(*map(sql_name, columns))
    hi, lo = digest_halves(row_text(rows.schema, strict=True))
    rows = df.select(*[c.alias(name) for name, c in by.items()], hi.alias("_hi"), lo.alias("_lo"), F.lit(1).alias("_n"))
    return _folded(rows.withColumns({"_hi_sum": F.col("_hi"), "_lo_sum": F.col("_lo")}), list(by))


def _folded(rows: DataFrame, by: list[str]) -> DataFrame:
    sums = {c: F.sum(F.col(c).cast("decimal(30,0)")) for c in ("_n", "_hi_sum", "_lo_sum")}
    folds = {c: F.bit_xor(c) for c in ("_hi", "_lo")}
    return rows.groupBy(*by).agg(*[(sums | folds)[c].alias(c) for c in _SUMS])


def leaf_digests(df: DataFrame, ranges: Ranges, columns: list[str] | None = None) -> DataFrame:
    """``_leaf`` and its digest, from one pass over the table."""
    return _digested(df, columns or df.columns, {"_leaf": ranges.leaf()})


def branch_digests(leaves: DataFrame, ranges: Ranges) -> DataFrame:
    return _folded(leaves.withColumn("_branch", ranges.branch()), ["_branch"])


def _unequal(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose digests are not the same on both sides, and the kind of difference."""
    there = target.select(*[F.col(c).alias(f"_t{c}") for c in [*by, *_SUMS]])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t{c}")) for c in by])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t{c}")) for c in _SUMS])
    kind = F.when(F.col("_t_n").isNull(), MISSING).when(F.col("_n").isNull(), EXTRA).otherwise(CHANGED)
    return source.join(there, on, "full").where(~same).select(
        *[F.when(F.col("_n").isNull(), F.col(f"_t{c}")).otherwise(F.col(c)).alias(c) for c in by], kind.alias("difference")
    )


def differing_leaves(source: DataFrame, target: DataFrame, ranges: Ranges) -> DataFrame:
    """``_leaf`` of each leaf that differs: branches first, then the leaves of those that do."""
    sides = [materialise(leaf_digests(df, ranges, source.columns), "leaves") for df in (source, target)]
    branches = _unequal(*[branch_digests(side, ranges) for side in sides], ["_branch"]).select("_branch")
    branches = materialise(branches, "branches")
    inner = [side.join(branches, ranges.branch().eqNullSafe(F.col("_branch")), "left_semi") for side in sides]
    return _unequal(*inner, ["_leaf"]).select("_leaf")


def within(df: DataFrame, ranges: Ranges, leaves: DataFrame) -> DataFrame:
    """The rows of some leaves (written ones). Few leaves of successive values become a filter that reaches the scan."""
    found = [r["_leaf"] for r in leaves.limit(MOST_LEAVES + 1).collect()] if ranges.width is not None else None
    if found is not None and len(found) <= MOST_LEAVES:
        key, numbers = F.col(sql_name(ranges.keys[0])), sorted(n for n in found if n is not None)
        firsts = [n for i, n in enumerate(numbers) if i == 0 or numbers[i - 1] != n - 1]
        lasts = [n for i, n in enumerate(numbers) if i == len(numbers) - 1 or numbers[i + 1] != n + 1]
        inside = [(key >= a * ranges.width) & (key < (b + 1) * ranges.width) for a, b in zip(firsts, lasts)]
        inside += [key.isNull()] if None in found else []
        return df.where(reduce(lambda a, b: a | b, inside, F.lit(False)))
    return df.join(leaves.select(F.col("_leaf").alias("_in")), ranges.leaf().eqNullSafe(F.col("_in")), "left_semi")


def diff_rows(source: DataFrame, target: DataFrame, ranges: Ranges, leaves: DataFrame | None = None) -> DataFrame:
    """The keys whose rows differ, and how: ``changed``, ``missing`` in the target, or ``extra`` there.

    ``target`` has the source's columns. A key that is there several times is changed unless all its rows are the same on both
    sides, however often. Null keys are keys. ``leaves`` are those that differ, if they are known already.
    """
    leaves = materialise(differing_leaves(source, target, ranges), "leaves") if leaves is None else leaves
    by = {k: F.col(sql_name(k)) for k in ranges.keys}
    sides = [_digested(within(df, ranges, leaves), source.columns, by) for df in (source, target)]
    return _unequal(*sides, list(ranges.keys))
