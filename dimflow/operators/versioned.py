"""Fully versioned dimensions: every observed change of a tracked column becomes a new version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.calendar import FAR_FUTURE, INCEPTION, ntz
from dimflow.functions.keys import differs, required, text_key
from dimflow.operators.surrogate import dense_keys, last_key

VALIDITY = ["valid_from", "valid_to", "is_current"]
NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


@dataclass(frozen=True)
class Wave:
    """What applying one snapshot did: the dimension after it, and the versions it added."""

    dim: DataFrame
    versions: DataFrame

    def summary(self) -> DataFrame:
        """One row: how many versions were added, how many expired."""
        return self.versions.agg(
            F.count(F.lit(1)).alias("n_new_versions"),
            F.count_if(F.col("change") == CHANGED).alias("n_expired"),
        )


def _keyed(snapshot: DataFrame, natural_key: str) -> DataFrame:
    return snapshot.withColumn(natural_key, text_key(required(natural_key, natural_key)))


def classify(dim: DataFrame, snapshot: DataFrame, natural_key: str, tracked: list[str]) -> DataFrame:
    """The snapshot with a ``change`` column: new, changed or unchanged against the current versions.

    Values are compared in the type the dimension has, so a key or a number that arrives in another
    type is no change. The snapshot holds one row per natural key.
    """
    current = dim.where("is_current").select(
        text_key(natural_key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in tracked]
    )
    old = [F.col(f"_old_{c}") for c in tracked]
    new = [F.col(c).cast(dim.schema[c].dataType) for c in tracked]
    change = (
        F.when(F.col("_key").isNull(), NEW).when(differs(new, old), CHANGED).otherwise(UNCHANGED)
    )
    keyed = _keyed(snapshot, natural_key)
    return keyed.join(current, F.col(natural_key) == F.col("_key"), "left").select(
        *snapshot.columns, change.alias("change")
    )


def _as_versions(rows: DataFrame, key_col: str, columns: list[str], as_of: Column) -> DataFrame:
    starts = F.when(F.col("change") == NEW, ntz(INCEPTION)).otherwise(as_of)
    return rows.select(
        key_col,
        *columns,
        starts.alias("valid_from"),
        ntz(FAR_FUTURE).alias("valid_to"),
        F.lit(True).alias("is_current"),
        "change",
    )


def single(rows: DataFrame, natural_key: str) -> DataFrame:
    """The rows; a natural key that is there twice is an error, as it would get two current versions."""
    twice = rows.groupBy(natural_key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
    if twice:
        raise ValueError(f"the snapshot holds {natural_key} {twice[0]} more than once")
    return rows


def initial_load(
    snapshot: DataFrame, key_col: str, natural_key: str, order_by: list[str] | None = None
) -> Wave:
    """The first build: every row is one version, valid from inception whenever the build runs."""
    rows = dense_keys(
        _keyed(snapshot, natural_key).withColumn("change", F.lit(NEW)), key_col, order_by or [natural_key]
    )
    versions = _as_versions(single(rows, natural_key), key_col, snapshot.columns, ntz(INCEPTION))
    return Wave(versions.drop("change"), versions)


def added_versions(
    current: DataFrame,
    snapshot: DataFrame,
    key_col: str,
    natural_key: str,
    tracked: list[str],
    as_of: Column,
    start_after: int,
    order_by: list[str] | None = None,
) -> DataFrame:
    """The versions a snapshot adds to a dimension whose ``current`` versions are given, with their ``change``.

    The snapshot meets the current versions in one join. Only what that join found to be new or changed is
    numbered, new keys first, and written.
    """
    found = classify(current, snapshot, natural_key, tracked).where(F.col("change") != UNCHANGED)
    typed = found.select(
        *[F.col(c).cast(current.schema[c].dataType).alias(c) for c in snapshot.columns if c != natural_key],
        text_key(natural_key).alias(natural_key),
        "change",
    ).select(*snapshot.columns, "change")
    order = [F.col("change") == CHANGED, *(order_by or [natural_key])]
    rows = single(dense_keys(typed, key_col, order, start_after=start_after), natural_key)
    return _as_versions(rows, key_col, snapshot.columns, as_of)


def same_shape(dim: DataFrame, snapshot: DataFrame, key_col: str) -> None:
    """Raise unless the snapshot has the dimension's own columns."""
    if list(dim.columns) != [key_col, *snapshot.columns, *VALIDITY]:
        raise ValueError(
            f"the dimension has columns {dim.columns}, the snapshot calls for "
            f"{[key_col, *snapshot.columns, *VALIDITY]}"
        )


def closed_at(as_of: Column) -> Column:
    """The end of a version closed at ``as_of``; an error for one that begins no earlier."""
    backwards = F.raise_error(F.lit("the snapshot is not later than a version it closes")).cast("timestamp_ntz")
    return F.when(as_of <= F.col("valid_from"), backwards).otherwise(as_of)


def apply_snapshot(
    dim: DataFrame | None,
    snapshot: DataFrame,
    key_col: str,
    natural_key: str,
    tracked: list[str],
    as_of: str | Column,
    order_by: list[str] | None = None,
) -> Wave:
    """Apply a full snapshot of current states to a dimension.

    New keys get a version valid from inception. A key with a changed tracked column has its current
    version closed at ``as_of`` and a new one opened there. Unchanged keys, and keys the snapshot does
    not mention, are left alone. Numbering continues after the greatest key, new keys first.

    Only what is new or changed is numbered and written, and the dimension is then joined with that, whose true
    size the optimizer knows. For a stored dimension see ``sources.history``, which leaves closed versions alone.
    """
    if dim is None:
        return initial_load(snapshot, key_col, natural_key, order_by)
    same_shape(dim, snapshot, key_col)
    as_of = ntz(as_of) if isinstance(as_of, str) else as_of
    start_after = last_key(dim, key_col)
    versions = added_versions(dim, snapshot, key_col, natural_key, tracked, as_of, start_after, order_by)
    closing = versions.where(F.col("change") == CHANGED).select(F.col(natural_key).alias("_closing"))
    closes = F.col("is_current") & F.col("_closing").isNotNull()
    kept = dim.join(closing, text_key(natural_key) == F.col("_closing"), "left").select(
        key_col,
        *[text_key(c).alias(c) if c == natural_key else F.col(c) for c in snapshot.columns],
        F.when(closes, closed_at(as_of)).otherwise(F.col("valid_to")).alias("valid_to"),
        F.col("valid_from"),
        (F.col("is_current") & ~closes).alias("is_current"),
    )
    return Wave(kept.select(*dim.columns).unionByName(versions.drop("change")), versions)


def multi_version_keys(dim: DataFrame, natural_key: str) -> DataFrame:
    """Natural keys with more than one version, and how many."""
    return (
        dim.groupBy(natural_key).agg(F.count(F.lit(1)).alias("n_versions")).where(F.col("n_versions") > 1)
    )
