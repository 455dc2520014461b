"""Fact tables: source rows with their dimension keys resolved."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.calendar import date_key
from dimflow.operators.pointintime import resolve, resolve_deep


@dataclass(frozen=True)
class VersionedRef:
    """A reference by source id to a versioned dimension, resolved at the fact's date.

    Set ``deep`` where some entities have more versions than that (see ``pointintime.resolve_deep``).
    """

    dim: str
    key_col: str
    dim_id: str
    fact_id: str
    deep: int | None = None


@dataclass(frozen=True)
class CurrentRef:
    """A reference to a current-state dimension; ``alias`` names the role it plays."""

    dim: str
    key_col: str
    dim_id: str
    fact_id: str
    alias: str


@dataclass(frozen=True)
class FactSpec:
    """One fact table: where it comes from, what it points to, and its columns in order.

    ``columns`` names the key and date columns made here along with the source columns kept. The stored fact is in
    ``buckets`` by hash of its id, or in ranges of ``id_range`` ids, the unit that a change rewrites.
    """

    name: str
    source: str
    id_col: str
    sk_col: str
    date_col: str
    columns: tuple[str, ...]
    versioned: tuple[VersionedRef, ...] = field(default=())
    current: tuple[CurrentRef, ...] = field(default=())
    buckets: int = 8
    id_range: int | None = None


def needed(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """The columns of the source rows that a fact is made of."""
    used = {spec.id_col, spec.date_col, *(r.fact_id for r in (*spec.versioned, *spec.current)), *spec.columns}
    return rows.select(*[c for c in rows.columns if c in used])


def build_fact(
    rows: DataFrame, spec: FactSpec, versions: dict[str, DataFrame], dims: dict[str, DataFrame]
) -> DataFrame:
    """Resolve every reference of ``spec``; no source row is lost, what is not found is NULL.

    ``versions`` holds, per versioned dimension, its versions by source id (see
    ``pointintime.entity_versions``), ``dims`` the current-state dimensions. All joins are left joins
    without hints: a dimension is broadcast when its measured size allows, else both sides are
    shuffled on the key and AQE splits a hot one. Current dimensions come first: they are mostly small, and what only they
    are looked up by is not moved for the others. Rows that lie by an id already are moved least if that reference is the
    first of ``versioned``.
    """
    fact = needed(rows, spec)
    for ref in spec.current:
        side = dims[ref.dim].select(
            F.col(ref.dim_id).alias("_dim_id"), F.col(ref.key_col).alias(ref.alias)
        )
        fact = fact.join(side, F.col(ref.fact_id) == F.col("_dim_id"), "left").drop("_dim_id")
    for ref in spec.versioned:
        join = resolve if ref.deep is None else partial(resolve_deep, deep=ref.deep)
        fact = join(fact, versions[ref.dim], ref.key_col, ref.dim_id, ref.fact_id, spec.date_col)
    made = {spec.sk_col: F.col(spec.id_col), "date_key": date_key(spec.date_col)}
    return fact.select(*[made[c].alias(c) if c in made else F.col(c) for c in spec.columns])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table, as ``<name>_rows``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in tables.items()
    ]
    union = counts[0]
    for count in counts[1:]:
        union = union.unionByName(count)
    return union.agg(
        *[F.max(F.when(F.col("name") == name, F.col("n"))).alias(f"{name}_rows") for name in tables]
    )
