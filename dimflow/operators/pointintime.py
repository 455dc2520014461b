"""Point-in-time joins: the dimension version that was valid at a fact's date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.keys import text_key
from dimflow.session import materialise


def resolve(
    facts: DataFrame,
    dim: DataFrame,
    key_col: str,
    natural_key: str,
    fact_key: str | Column,
    fact_date: str | Column,
    alias: str | None = None,
) -> DataFrame:
    """The facts with the key of the version with ``valid_from <= date < valid_to``, else NULL.

    An equi-join on the key (as text, where the types differ) with the range as a residual condition:
    a broadcast join where the versions are small, else a sort-merge join, in which AQE splits a hot key
    on the fact side. Only the four columns needed are read from the dimension. See
    :func:`resolve_deep` for keys with very many versions.
    """
    fact_key, side = _comparable(facts, fact_key, _versions(dim, key_col, natural_key))
    return facts.join(side, (fact_key == F.col("_key")) & _covers(fact_date), "left").select(
        *facts.columns, F.col("_version").alias(alias or key_col)
    )


def resolve_deep(
    facts: DataFrame,
    dim: DataFrame,
    key_col: str,
    natural_key: str,
    fact_key: str | Column,
    fact_date: str | Column,
    alias: str | None = None,
    deep: int = 64,
    cell: str = "month",
) -> DataFrame:
    """As :func:`resolve`, for dimensions in which some keys have a long history.

    The residual of a plain join looks at every version of the key for every fact. Here keys with more
    than ``deep`` versions are joined on the calendar cell of the fact's date as well, each version
    standing in every cell it overlaps between the first and the last fact. As the versions of a key
    do not overlap, it has at most as many such rows as versions and cells together.
    """
    fact_key, side = _comparable(facts, fact_key, _versions(dim, key_col, natural_key))
    fact_date = F.col(fact_date) if isinstance(fact_date, str) else fact_date
    depth = side.groupBy(F.col("_key").alias("_depth_key")).agg(F.count(F.lit(1)).alias("_depth"))
    # Written, as later joins split a hot key only if both sides come straight from a shuffle.
    counted = materialise(side.join(depth, F.col("_key") == F.col("_depth_key")).drop("_depth_key"), "depths")
    span = facts.agg(
        F.struct(
            F.min(fact_date).cast("timestamp_ntz").alias("first"),
            F.max(fact_date).cast("timestamp_ntz").alias("last"),
        ).alias("span")
    ).scalar()
    first, last = span["first"], span["last"]
    shallow = counted.where(F.col("_depth") <= deep)
    cells = F.sequence(
        _cell(F.greatest("_from", first), cell),
        _cell(F.least("_to", last), cell),
        F.expr(f"interval 1 {cell}"),
    )
    celled = (
        counted.where((F.col("_depth") > deep) & (F.col("_from") <= last) & (F.col("_to") > first))
        .select("_key", "_from", "_to", "_version", F.explode(cells).alias("_cell"))
        .select(
            F.col("_key").alias("_deep_key"),
            F.col("_from").alias("_deep_from"),
            F.col("_to").alias("_deep_to"),
            F.col("_version").alias("_deep_version"),
            "_cell",
        )
    )
    found = facts.join(shallow, (fact_key == F.col("_key")) & _covers(fact_date), "left").join(
        celled,
        (fact_key == F.col("_deep_key"))
        & (_cell(fact_date, cell) == F.col("_cell"))
        & (fact_date >= F.col("_deep_from"))
        & (fact_date < F.col("_deep_to")),
        "left",
    )
    return found.select(
        *facts.columns, F.coalesce("_version", "_deep_version").alias(alias or key_col)
    )


def coverage(resolved: DataFrame, key_col: str, by: list[str]) -> DataFrame:
    """How many facts found a version, per group."""
    return resolved.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_facts"), F.count(key_col).alias("n_resolved")
    )


def entity_versions(
    entity: DataFrame, dim: DataFrame, id_col: str, key_col: str, natural_key: str
) -> DataFrame:
    """Versions by the source's id, ready for :func:`resolve` with ``natural_key=id_col``.

    Facts carry the id of an entity, versions its natural key. Joining those two here, among rows of
    dimension size, spares the facts a join of their own. Entities without a version drop out, which
    leaves their facts unresolved as it should.
    """
    codes = entity.select(F.col(id_col), text_key(natural_key).alias("_code"))
    versions = dim.select(text_key(natural_key).alias("_dim_code"), key_col, "valid_from", "valid_to")
    return codes.join(versions, F.col("_code") == F.col("_dim_code")).select(
        id_col, key_col, "valid_from", "valid_to"
    )


def _versions(dim: DataFrame, key_col: str, natural_key: str) -> DataFrame:
    return dim.select(
        F.col(natural_key).alias("_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        F.col(key_col).alias("_version"),
    )


def _comparable(facts: DataFrame, fact_key: str | Column, side: DataFrame) -> tuple[Column, DataFrame]:
    """Both keys in one type: as they are if that is so already, else as text."""
    fact_key = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    if facts.select(fact_key).schema[0].dataType == side.schema["_key"].dataType:
        return fact_key, side
    return text_key(fact_key), side.withColumn("_key", text_key("_key"))


def _covers(fact_date: str | Column) -> Column:
    at = F.col(fact_date) if isinstance(fact_date, str) else fact_date
    return (at >= F.col("_from")) & (at < F.col("_to"))


def _cell(column: Column, unit: str) -> Column:
    return F.date_trunc(unit, column).cast("timestamp_ntz")
