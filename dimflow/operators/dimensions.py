"""Dimensions that keep no history of their own: current-state, effective-dated and calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.calendar import date_key, iso_weekday
from dimflow.operators.surrogate import dense_keys


def current_state(source: DataFrame, key_col: str, order_by: list[str]) -> DataFrame:
    """A dimension that holds the source rows as they are now, behind a dense surrogate key."""
    return dense_keys(source, key_col, order_by)


def effective_dated(source: DataFrame, key_col: str, order_by: list[str]) -> DataFrame:
    """A dimension whose validity the source states itself; nothing is snapshotted on top."""
    return dense_keys(source, key_col, order_by)


def effective_lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    at: str | Column,
    valid_from: str,
    valid_until: str,
    take: dict[str, str],
) -> DataFrame:
    """Rows of an effective-dated dimension valid at a date, both bounds included.

    ``on`` maps fact columns to dimension columns, ``take`` dimension columns to output names. A fact
    valid under several rows appears once for each; one valid under none is kept with NULLs.
    """
    at = F.col(at) if isinstance(at, str) else at
    side = dim.select(
        *[F.col(d).alias(f"_on_{i}") for i, d in enumerate(on.values())],
        F.col(valid_from).cast("date").alias("_from"),
        F.col(valid_until).cast("date").alias("_until"),
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    keys = [F.col(f) == F.col(f"_on_{i}") for i, f in enumerate(on)]
    day = F.to_date(at)
    condition = reduce(lambda a, b: a & b, [*keys, day >= F.col("_from"), day <= F.col("_until")])
    return facts.join(side, condition, "left").select(*facts.columns, *take.values())


def date_dimension(dates: list[Column], frames: list[DataFrame]) -> DataFrame:
    """One row per day between the first and the last date found in the given columns.

    Only one row of bounds per input leaves the aggregates; no input rows, no calendar.
    """
    bounds = [
        frame.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
        for frame, col in zip(frames, dates, strict=True)
    ]
    span = reduce(DataFrame.unionByName, bounds).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    day = F.col("date")
    return (
        span.where(F.col("lo").isNotNull())
        .select(F.explode(F.sequence("lo", "hi")).alias("date"))
        .select(
            date_key(day).alias("date_key"),
            day,
            iso_weekday(day).alias("day_of_week"),
            F.month(day).alias("month"),
            F.quarter(day).alias("quarter"),
            F.year(day).alias("year"),
        )
    )
