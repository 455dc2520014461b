"""Incremental reads past a high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.calendar import ntz


def past_mark(
    source: DataFrame,
    mark: str | None = None,
    updated_at: str = "updated_at",
    inclusive: bool = False,
    cap_at: str | None = None,
) -> DataFrame:
    """Rows changed after the mark; the comparison reaches the scan.

    Strict by default. ``inclusive`` pulls the rows at the mark again, which is safe as the upsert is
    idempotent, and catches rows that reached the mark's instant late. ``cap_at`` leaves out rows
    stamped later than that, so that a stamp in the future cannot move the mark past rows to come.
    Without a mark, on a first load, every stamped row is pulled. Rows without a stamp never are.
    """
    stamp = F.col(updated_at)
    if mark is None:
        rows = source.where(stamp.isNotNull())
    else:
        rows = source.where(stamp >= ntz(mark) if inclusive else stamp > ntz(mark))
    return rows if cap_at is None else rows.where(stamp <= ntz(cap_at))


def high_water(batch: DataFrame, updated_at: str = "updated_at") -> DataFrame:
    """The mark a batch moves its table to: one row, NULL for an empty batch."""
    return batch.agg(F.max(updated_at).alias("last_watermark"))
