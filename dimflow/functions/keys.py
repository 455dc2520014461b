"""Key columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(column: str | Column, name: str) -> Column:
    """The column itself; a row in which it is NULL fails the query with a clear message."""
    col = F.col(column) if isinstance(column, str) else column
    return F.when(col.isNull(), F.raise_error(F.lit(f"NULL in key column {name}"))).otherwise(col)


def text_key(column: str | Column) -> Column:
    """A natural key as text, so that ``700001`` and ``'700001'`` are one key."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def hash_bucket(keys: list[str], buckets: int) -> Column:
    """The hash bucket of a key tuple."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def differs(left: list[Column], right: list[Column]) -> Column:
    """True when any pair differs; two NULLs are equal, a NULL and a value are not."""
    pairs = [~a.eqNullSafe(b) for a, b in zip(left, right, strict=True)]
    return reduce(lambda a, b: a | b, pairs, F.lit(False))
