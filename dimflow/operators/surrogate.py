"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.session import materialise

_POSITION = "_position"
_ROW_BITS = 33  # monotonically_increasing_id() keeps the row within its partition in the low 33 bits


def dense_keys(
    df: DataFrame, key_col: str, order_by: list[str | Column], start_after: int = 0
) -> DataFrame:
    """Prepend ``key_col``: 1..n in the order of ``order_by``, or continuing after ``start_after``.

    The rows are range-partitioned and sorted, each gets its partition and place in it, and the
    result is written once, which fixes the numbering whatever is recomputed later. A key is then
    the place plus the number of rows in the partitions before; those numbers, one per partition
    whatever the number of rows, are all that reaches the driver. What comes back is a projection of
    the written rows, cheap to read more than once.

    Give a unique ``order_by``: equal rows cannot be spread over partitions, and their order among
    themselves is open.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id()),
        "ordered",
    )
    partition = F.shiftright(F.col(_POSITION), _ROW_BITS).cast("int")
    sizes = dict(placed.groupBy(partition).count().collect())
    last = max(sizes, default=0)
    before = accumulate((sizes.get(p, 0) for p in range(last)), initial=start_after)
    # One text literal, folded into an array once: thousands of partitions do not swell the plan.
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    place = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return placed.select((F.get(offsets, partition) + place).alias(key_col), *[F.col(f"`{c}`") for c in df.columns])


def last_key(df: DataFrame, key_col: str) -> int:
    """The greatest key in use, 0 when there is none."""
    return df.agg(F.coalesce(F.max(key_col), F.lit(0))).first()[0]
