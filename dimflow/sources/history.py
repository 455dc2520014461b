"""Dimensions in the store that grow by waves: versions, and surrogate keys that stay.

A versioned dimension is stored in two parts. Current versions are in buckets of their natural key; closed ones are
kept for good, a directory for each wave. A wave reads the current part only, rewrites the buckets of keys that changed or came, and
adds the versions it closed. What it added is its delta, which derived tables read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.calendar import ntz
from dimflow.functions.keys import required, text_key
from dimflow.operators.surrogate import dense_keys
from dimflow.operators.versioned import CHANGED, added_versions, closed_at, initial_load, same_shape
from dimflow.registry import TableSpec
from dimflow.sources.store import Store


@dataclass(frozen=True)
class WaveCounts:
    """How many versions a wave added, and how many of them closed another."""

    n_new_versions: int
    n_expired: int


def apply_wave(
    store: Store,
    layer: str,
    name: str,
    snapshot: DataFrame,
    key_col: str,
    natural_key: str,
    tracked: list[str],
    as_of: str,
    order_by: list[str] | None = None,
    buckets: int = 8,
) -> WaveCounts:
    """As ``versioned.apply_snapshot``, for a dimension in the store. A snapshot without a change commits nothing."""
    spec, commit = TableSpec(name, (natural_key,), buckets=buckets), store.commit(layer, name)
    if commit is None:
        versions = initial_load(snapshot, key_col, natural_key, order_by).versions
    else:
        current = store.current(layer, name)
        same_shape(current, snapshot, key_col)
        versions = added_versions(
            current, snapshot, key_col, natural_key, tracked, ntz(as_of), commit.last_key or 0, order_by
        )
    counts = versions.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("change") == CHANGED).alias("closed")).first()
    rows, delta = versions.drop("change"), versions.select(natural_key, key_col, "valid_from", "change")
    if commit is None:
        store.add(layer, spec, rows, last_key=counts.n)
    elif counts.n:
        changed = versions.where(F.col("change") == CHANGED).select(natural_key)
        taken = kept = None
        if counts.closed:
            taken = changed
            kept = store.touched(layer, spec, changed).join(changed, natural_key, "left_semi").withColumns(
                {"valid_to": closed_at(ntz(as_of)), "is_current": F.lit(False)}
            ).select(*current.columns)
        store.add(layer, spec, rows, commit.last_key + counts.n, taken, kept, delta)
    return WaveCounts(counts.n, counts.closed)


def stable_keys(
    store: Store, layer: str, name: str, rows: DataFrame, key_col: str, id_cols: list[str]
) -> DataFrame:
    """The rows behind surrogate keys that stay as they are whatever rows come in between or go.

    The keys are in a table of their own, ``name``, which is only added to: ids it does not hold are numbered after the
    greatest key given out, in the order of the ids, in parallel. An id that went keeps its key for when it returns.
    Ids are unique and not null.
    """
    spec, commit = TableSpec(name, tuple(id_cols)), store.commit(layer, name)
    ids = rows.select(*[required(c, c).alias(c) for c in id_cols])
    twice = ids.groupBy(*id_cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
    if twice:
        raise ValueError(f"{name}: {tuple(twice)[:-1]} is there {twice['_n']} times")
    last = (commit.last_key or 0) if commit else 0
    fresh = ids.join(store.read(layer, name).select(*id_cols), id_cols, "left_anti") if commit else ids
    numbered = dense_keys(fresh, key_col, list(id_cols), start_after=last)
    if n := numbered.count():
        store.keep(layer, spec, numbered, last + n)
    elif commit is None:
        store.create(layer, spec, numbered.schema)
    keys = store.read(layer, name)
    return rows.join(keys, id_cols).select(key_col, *rows.columns)


def replace_current(store: Store, layer: str, name: str, rows: DataFrame, id_col: str) -> DataFrame:
    """Replace a current-state dimension; its delta are the ids that came or went."""
    old = store.find(layer, name)
    delta = None
    if old is not None:
        before, after = (df.select(F.col(id_col).alias("_id")) for df in (old, rows))
        delta = before.join(after, "_id", "left_anti").unionAll(after.join(before, "_id", "left_anti"))
    return store.replace(layer, name, rows, delta)


def entity_ids(store: Store, layer: str, name: str, entity: DataFrame, id_col: str, natural_key: str, buckets: int = 8) -> None:
    """Keep which natural key each source id has; the delta are ids that are new, gone or of another key."""
    spec = TableSpec(name, (id_col,), buckets=buckets)
    now = entity.select(id_col, text_key(natural_key).alias("code"))
    known = store.find(layer, name)
    if known is None:
        if store.upsert(layer, spec, now) == 0:
            store.create(layer, spec, now.schema)
        return
    other = now.join(known, [id_col, "code"], "left_anti")
    store.upsert(layer, spec, other, gone=known.join(now, id_col, "left_anti"))
