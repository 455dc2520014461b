"""Build a star schema from the raw layer."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.keys import text_key
from dimflow.operators.dimensions import date_dimension
from dimflow.operators.facts import FactSpec, build_fact, needed, row_counts
from dimflow.operators.pointintime import entity_versions
from dimflow.registry import TableSpec
from dimflow.session import materialise, side_by_side
from dimflow.sources.history import WaveCounts, apply_wave, entity_ids, replace_current, stable_keys
from dimflow.sources.store import ANALYTICS, AUDIT_TABLES, RAW, Store


@dataclass(frozen=True)
class VersionedDim:
    """A fully versioned dimension; ``id_col`` is the source key facts refer to, ``buckets`` splits the current versions."""

    name: str
    source: str
    key_col: str
    natural_key: str
    id_col: str
    tracked: tuple[str, ...]
    buckets: int = 8


@dataclass(frozen=True)
class CurrentDim:
    """A dimension rebuilt from the source rows behind keys that stay; with ``effective`` these carry their own validity."""

    name: str
    source: str
    key_col: str
    id_col: str
    effective: bool = False


@dataclass(frozen=True)
class Star:
    """A star schema: its dimensions, its facts and the calendar over the facts' dates."""

    versioned: tuple[VersionedDim, ...]
    current: tuple[CurrentDim, ...]
    facts: tuple[FactSpec, ...]
    calendar: str = "dim_date"


def build_star(store: Store, star: Star, as_of: str, run_id: str | None = None) -> DataFrame:
    """Bring every table of the star up to date; one row with their row counts comes back.

    Versioned dimensions are extended, and left untouched when the snapshot holds no change; what a wave did goes
    into the audit if the run has an id. Current dimensions are replaced behind keys that stay. Of a fact that was built
    before, only the rows that what has changed since can reach are built again, see :func:`affected`.
    """
    raw = {
        name: store.read(RAW, name)
        for name in {d.source for d in (*star.versioned, *star.current)} | {f.source for f in star.facts}
    }

    def build_dim(dim: VersionedDim | CurrentDim) -> WaveCounts | None:
        rows = raw[dim.source]
        if isinstance(dim, VersionedDim):
            entity_ids(store, ANALYTICS, ids_of(dim), rows, dim.id_col, dim.natural_key, dim.buckets)
            return apply_wave(
                store, ANALYTICS, dim.name, rows, dim.key_col, dim.natural_key, list(dim.tracked), as_of, [dim.id_col], dim.buckets
            )
        keyed = stable_keys(store, ANALYTICS, f"{dim.name}_keys", rows, dim.key_col, [dim.id_col])
        replace_current(store, ANALYTICS, dim.name, keyed, dim.id_col)
        return None

    def build_calendar(name: str) -> None:
        dates = [F.col(f.date_col) for f in star.facts]
        store.replace(ANALYTICS, name, date_dimension(dates, [raw[f.source] for f in star.facts]))

    dims = (*star.versioned, *star.current)
    work = [(build_dim, dim) for dim in dims] + [(build_calendar, star.calendar)]
    *waves, _ = side_by_side(store.spark, lambda job: job[0](job[1]), work)
    if run_id is not None and star.versioned:
        counts = [(run_id, d.name, w.n_new_versions, w.n_expired) for d, w in zip(dims, waves) if w is not None]
        store.append("dimension_waves", store.spark.createDataFrame(counts, AUDIT_TABLES["dimension_waves"]).coalesce(1))
    side_by_side(store.spark, lambda fact: extend_fact(store, star, fact, raw), star.facts)
    names = [dim.name for dim in dims] + [f.name for f in star.facts]
    return row_counts({name: store.read(ANALYTICS, name) for name in names})


def ids_of(dim: VersionedDim) -> str:
    """The table that keeps which natural key each source id has."""
    return f"{dim.name}_ids"


def extend_fact(store: Store, star: Star, spec: FactSpec, raw: dict[str, DataFrame]) -> None:
    """Build a fact, or bring it up to date where it was built from earlier states of the same tables."""
    by_name = {d.name: d for d in (*star.versioned, *star.current)}
    used = [by_name[r.dim] for r in spec.versioned]
    names = [(RAW, spec.source)] + [(ANALYTICS, n) for d in used for n in (d.name, ids_of(d))]
    names += [(ANALYTICS, r.dim) for r in spec.current]
    inputs = {f"{layer}.{name}": store.commit(layer, name).generation for layer, name in names}
    table = TableSpec(spec.name, (spec.sk_col,), buckets=spec.buckets, id_range=spec.id_range)
    before = store.commit(ANALYTICS, spec.name)
    rows, ids = raw[spec.source], None
    if before is not None and before.inputs == inputs:
        return
    if before is not None and before.inputs.keys() == inputs.keys():
        ids = affected(store, spec, by_name, raw, before.inputs, inputs)
    if ids is not None:
        ids = materialise(ids, "affected")
        rows = materialise(needed(rows, spec).join(ids, spec.id_col, "left_semi"), "affected-rows")

    def versions_of(dim: VersionedDim) -> DataFrame:
        entity = raw[dim.source]
        if ids is not None:
            wanted = [rows.select(F.col(r.fact_id).alias(dim.id_col)) for r in spec.versioned if r.dim == dim.name]
            entity = entity.join(reduce(DataFrame.unionAll, wanted).distinct(), dim.id_col, "left_semi")
        found = entity_versions(entity, store.read(ANALYTICS, dim.name), dim.id_col, dim.key_col, dim.natural_key)
        # Written, its size is known: facts are shuffled only for dimensions too large to broadcast.
        return materialise(found, "versions")

    versions = {d.name: versions_of(d) for d in used}
    fact = build_fact(rows, spec, versions, {r.dim: store.read(ANALYTICS, r.dim) for r in spec.current})
    if ids is None:
        store.add(ANALYTICS, table, fact, inputs=inputs, whole=True)
    else:
        fact, taken = materialise(fact, "fact"), ids.withColumnRenamed(spec.id_col, spec.sk_col)
        store.add(ANALYTICS, table, fact, taken=taken, inputs=inputs)


def affected(
    store: Store, spec: FactSpec, dims: dict[str, VersionedDim | CurrentDim], raw: dict[str, DataFrame],
    before: dict[str, int], now: dict[str, int],
) -> DataFrame | None:
    """Ids of the facts that the changes of their inputs between two states can change; None if some kept no record.

    These are the raw rows put in, replaced or taken out; facts of an entity with a new version, from the day that is
    valid from on; facts of an entity whose natural key is new or another; and facts of ids that came to or went
    from a current dimension. Of the raw table only the columns of ids and date are read for the last three.
    """
    found: list[DataFrame] = []
    rows, wanted = raw[spec.source], F.col(spec.id_col)

    def delta(layer: str, name: str) -> DataFrame | None:
        key = f"{layer}.{name}"
        return None if before[key] == now[key] else store.deltas(layer, name, before[key])

    def unknown(layer: str, name: str) -> bool:
        return before[f"{layer}.{name}"] != now[f"{layer}.{name}"] and delta(layer, name) is None

    names = [(RAW, spec.source)] + [(ANALYTICS, n) for r in spec.versioned for n in (r.dim, ids_of(dims[r.dim]))]
    if any(unknown(*name) for name in [*names, *((ANALYTICS, r.dim) for r in spec.current)]):
        return None
    if (changed := delta(RAW, spec.source)) is not None:
        found.append(changed.select(wanted))
    for ref in spec.versioned:
        dim = dims[ref.dim]
        if (added := delta(ANALYTICS, dim.name)) is not None:
            since = added.groupBy(text_key(dim.natural_key).alias("_code")).agg(F.min("valid_from").alias("_since"))
            entity = raw[dim.source].select(F.col(dim.id_col).alias("_id"), text_key(dim.natural_key).alias("_code"))
            since = materialise(entity.join(since, "_code").select("_id", "_since"), "since")
            later = (F.col(ref.fact_id) == F.col("_id")) & (F.col(spec.date_col) >= F.col("_since"))
            found.append(rows.join(since, later, "left_semi").select(wanted))
        if (other := delta(ANALYTICS, ids_of(dim))) is not None:
            other = other.select(F.col(dim.id_col).alias("_id")).distinct()
            found.append(rows.join(other, F.col(ref.fact_id) == F.col("_id"), "left_semi").select(wanted))
    for ref in spec.current:
        if (other := delta(ANALYTICS, ref.dim)) is not None:
            found.append(rows.join(other.distinct(), F.col(ref.fact_id) == F.col("_id"), "left_semi").select(wanted))
    return reduce(DataFrame.unionAll, found).distinct() if found else rows.select(wanted).limit(0)
