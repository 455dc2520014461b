"""Load source tables into the raw layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.operators.digests import CHANGED, EXTRA, MISSING, Ranges, diff_rows, differing_leaves, within
from dimflow.operators.highwater import past_mark
from dimflow.registry import TableSpec
from dimflow.session import materialise, side_by_side
from dimflow.sources.readers import Source
from dimflow.sources.store import RAW, Store

@dataclass(frozen=True)
class Repaired:
    """What a repair put right: rows that were other than the source's, rows that lacked, rows gone at the source."""

    changed: int = 0
    missing: int = 0
    extra: int = 0


LOADED = "table_name string, mode string, n_rows bigint"


def load_incremental(store: Store, source: Source, spec: TableSpec, inclusive: bool | None = None) -> int:
    """Upsert the rows past the table's mark, all stamped rows where there is none; nothing past it is a no-op.

    The first load of a table without rows makes an empty raw table.
    """
    commit = store.commit(RAW, spec.name)
    mark = commit.mark.strftime("%Y-%m-%d %H:%M:%S.%f") if commit and commit.mark else None
    again = spec.inclusive if inclusive is None else inclusive
    batch = past_mark(source(spec.name), mark, spec.updated_at, again, spec.cap_at)
    loaded = store.upsert(RAW, spec, batch)
    if commit is None and loaded == 0:
        store.create(RAW, spec, batch.schema)
    return loaded


def load_replaced(store: Store, source: Source, spec: TableSpec) -> int:
    """Replace a lookup table whole."""
    return store.replace(RAW, spec.name, source(spec.name)).count()


def repair(store: Store, source: Source, spec: TableSpec, ranges: Ranges | None = None) -> Repaired:
    """Make a loaded table equal to its source where no stamp moved, or where rows are gone.

    Both sides are compared by digests of key ranges. Only ranges that differ are read again, of them only rows that
    differ are put in, and of the stored table only the buckets of those are rewritten, in one commit whose delta
    derived tables read as that of any load. Without a difference nothing is committed. Without ``ranges``, keys
    fall into ranges by their hash.
    """
    rows, stored = source(spec.name), store.read(RAW, spec.name)
    ranges = ranges or Ranges(spec.keys)
    leaves = materialise(differing_leaves(rows, stored, ranges), "leaves")
    diff = materialise(diff_rows(rows, stored, ranges, leaves), "differences")
    counts = {r.difference: r["count"] for r in diff.groupBy("difference").count().collect()}
    if counts:
        keys = list(spec.keys)
        wanted, gone = diff.where(F.col("difference") != EXTRA).select(*keys), diff.where(F.col("difference") == EXTRA).select(*keys)
        again = within(rows, ranges, leaves).join(wanted, keys, "left_semi").select(*stored.columns)
        out = within(stored, ranges, leaves).join(gone, keys, "left_semi").select(*stored.columns)
        store.upsert(RAW, spec, again, gone=out, keep_newer=False)
    return Repaired(*(counts.get(kind, 0) for kind in (CHANGED, MISSING, EXTRA)))


def run(store: Store, source: Source, specs: list[TableSpec]) -> DataFrame:
    """Load every declared table, side by side, and return what was loaded how."""

    def load(spec: TableSpec) -> tuple[str, str, int]:
        if spec.incremental:
            return spec.name, "incremental", load_incremental(store, source, spec)
        return spec.name, "replace", load_replaced(store, source, spec)

    return store.spark.createDataFrame(side_by_side(store.spark, load, specs), LOADED)
