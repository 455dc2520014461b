"""Dates, weeks and the identifiers made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bounds of an open validity interval.
INCEPTION = "1900-01-01 00:00:00"
FAR_FUTURE = "9999-12-31 00:00:00"


def ntz(text: str) -> Column:
    """A timestamp without time zone, from text."""
    return F.lit(text).cast("timestamp_ntz")


def date_key(column: str | Column) -> Column:
    """``yyyyMMdd`` as an integer, by arithmetic: no text is made on the way."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def iso_weekday(column: str | Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(column) + 1


def week_period(column: str | Column) -> Column:
    """``monday/sunday`` of the week a timestamp falls in."""
    monday = F.trunc(column, "week")
    return F.concat(
        F.date_format(monday, "yyyy-MM-dd"),
        F.lit("/"),
        F.date_format(F.date_add(monday, 6), "yyyy-MM-dd"),
    )


def batch_id(node: str | Column, at: str | Column) -> Column:
    """The identifier of the batch a node assembles in one week."""
    node = F.col(node) if isinstance(node, str) else node
    return F.concat(F.lit("BATCH-"), node.cast("string"), F.lit("-"), week_period(at))
