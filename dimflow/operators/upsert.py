"""Keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimflow.functions.keys import required


def keyed(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch; a NULL in a key column is an error, as such a row would never be replaced."""
    return batch.select(*[required(c, c).alias(c) if c in keys else F.col(c) for c in batch.columns])


def latest_per_key(batch: DataFrame, keys: list[str], updated_at: str | None = None) -> DataFrame:
    """One row per key: the latest by ``updated_at``, ties broken by the other columns.

    An aggregate rather than a window, so that many copies of one key shrink before the shuffle.
    """
    ranked = [updated_at] if updated_at else []
    ranked += [c for c in batch.columns if c not in keys and c != updated_at]
    rows = keyed(batch, keys)
    if not ranked:
        return rows.distinct()
    return (
        rows.groupBy(*keys)
        .agg(F.max(F.struct(*ranked)).alias("_latest"))
        .select(*[F.col(c) if c in keys else F.col(f"_latest.`{c}`").alias(c) for c in batch.columns])
    )


def repeats(rows: DataFrame, keys: list[str]) -> bool:
    """Is a key there more than once? Only keys are read and moved."""
    most = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return (most or 0) > 1


def keyed_upsert(
    base: DataFrame, batch: DataFrame, keys: list[str], updated_at: str | None = None
) -> DataFrame:
    """The base without the rows whose key is in the batch, plus the batch.

    Applying the same batch twice gives the same table as once.
    """
    same_columns(base.schema, batch.schema)
    fresh = latest_per_key(batch, keys, updated_at)
    return replace_keys(base, fresh, keys)


def replace_keys(base: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """As :func:`keyed_upsert`, for a batch known to hold one row per key."""
    return base.join(fresh.select(*keys), keys, "left_anti").select(*base.columns).unionByName(fresh)


def older_than(fresh: DataFrame, base: DataFrame, keys: list[str], updated_at: str) -> DataFrame:
    """Keys of fresh rows for which the base has a later stamp; a tie, or no stamp in the base, is not later.

    Only keys and stamps of the base are read, and it is not moved if the batch is small enough to broadcast.
    """
    stamps = fresh.select(*keys, F.col(updated_at).alias("_stamp"))
    later = (F.col(updated_at) > F.col("_stamp")) | (F.col("_stamp").isNull() & F.col(updated_at).isNotNull())
    return base.select(*keys, updated_at).join(stamps, keys).where(later).select(*keys)


def any_later(fresh: DataFrame, base: DataFrame, updated_at: str) -> bool:
    """Could :func:`older_than` find a key? Not if no stamp of the base is later than the first of the fresh rows."""
    last = base.agg(F.max(updated_at).alias("_last"))
    first = fresh.agg(F.min(updated_at).alias("_first"), F.count_if(F.col(updated_at).isNull()).alias("_unstamped"))
    later = (F.col("_last") > F.col("_first")) | (F.col("_last").isNotNull() & (F.col("_unstamped") > 0))
    return last.crossJoin(first).select(F.coalesce(later, F.lit(False))).first()[0]


def same_columns(table: StructType, batch: StructType) -> None:
    """Raise unless both have the same columns in the same types."""
    have = {f.name: f.dataType for f in table.fields}
    got = {f.name: f.dataType for f in batch.fields}
    if have != got:
        missing = sorted(have.keys() - got.keys())
        extra = sorted(got.keys() - have.keys())
        retyped = sorted(c for c in have.keys() & got.keys() if have[c] != got[c])
        raise ValueError(f"batch does not fit the table: missing {missing}, extra {extra}, retyped {retyped}")
