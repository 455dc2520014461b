"""Layout advice from measured statistics: how to distribute a table, and how to sort it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.names import sql_name, sql_text

# The rules' thresholds.
SMALL_TABLE_ROWS = 5000
HIGH_CARDINALITY = 0.05
SKEWED_CARDINALITY = 0.01

STATS_SCHEMA = (
    "table_name string, row_count bigint, "
    "distincts array<struct<position:int,name:string,n:bigint>>, lengths map<string,int>"
)


@dataclass(frozen=True)
class Usage:
    """How queries use a table: the columns joined on, ranged over and compared for equality."""

    join_keys: tuple[str, ...] = ()
    range_filter: str | None = None
    equality_filters: tuple[str, ...] = ()


@dataclass(frozen=True)
class SortAdvice:
    """The sort a usage profile calls for."""

    columns: tuple[str, ...]
    style: str
    rationale: str


def text_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def table_stats(
    df: DataFrame, table: str, keys: tuple[str, ...] = (), approx: bool = False, in_bytes: bool = False
) -> DataFrame:
    """One row from one pass: row count, distinct values of each key, longest text per text column.

    Texts are measured in characters, or with ``in_bytes`` in bytes of UTF-8.

    Exact distinct counts shuffle the distinct values of each key, after dropping repeats on the map
    side; ``approx`` replaces them by sketches of fixed size. NULLs are not counted.
    """
    count = "approx_count_distinct({})" if approx else "count(distinct {})"
    distincts = [
        f"named_struct('position', {i}, 'name', {sql_text(k)}, 'n', {count.format(sql_name(k))})" for i, k in enumerate(keys)
    ]
    width = "octet_length" if in_bytes else "length"
    lengths = [f"{sql_text(t)}, coalesce(max({width}({sql_name(t)})), 0)" for t in text_columns(df.schema)]
    return df.agg(
        F.expr("count(1)").alias("row_count"),
        F.expr(f"array({', '.join(distincts)})").alias("distincts"),
        F.expr(f"map({', '.join(lengths)})").alias("lengths"),
    ).select(F.lit(table).alias("table_name"), "*").to(T.StructType.fromDDL(STATS_SCHEMA))


def key_cardinality(stats: DataFrame) -> DataFrame:
    """One row per table and join key: rows, distinct values and their ratio."""
    return stats.selectExpr("table_name", "row_count", "inline(distincts)").selectExpr(
        "table_name",
        "name as column_name",
        "row_count",
        "n as distinct_count",
        "case when row_count > 0 then n / row_count else 0D end as ratio",
    )


def distribution(stats: DataFrame) -> DataFrame:
    """The stats rows with ``diststyle``, ``distkey``, a rationale and what to do in Spark.

    The candidate is the join key with the greatest share of distinct values, the first one on a tie.
    """
    ranked = (
        "transform(distincts, d -> struct(case when row_count > 0 then d.n / row_count else 0D end as ratio, "
        "-d.position as rank, d.name as name))"
    )
    rows, percent = "format_number(row_count, 0)", "format_number(best.ratio * 100, 1)"
    # The wording of the advice.
    small = (
        f"concat('DISTSTYLE ALL: only ', {rows}, "
        "' rows -- cheaper to replicate to every node than redistribute.')"
    )
    keyed = (
        f"concat('DISTKEY(', best.name, '): ', {percent}, '% cardinality (', "
        f"format_number(cast(best.ratio * row_count as bigint), 0), '/', {rows}, "
        "'), dominant join column on this fact\\'s queries.')"
    )
    skewed = (
        f"concat('DISTSTYLE EVEN: best join-key candidate (', best.name, ') is only ', {percent}, "
        "'% cardinality -- a DISTKEY here would skew badly onto very few slices.')"
    )
    neither = "'DISTSTYLE EVEN: no join key clears the cardinality bar for a safe DISTKEY.'"
    return (
        stats.withColumn("best", F.expr(f"array_max(filter({ranked}, d -> d.ratio > 0))"))
        .withColumn(
            "diststyle",
            F.expr(
                f"case when startswith(table_name, 'dim_') and row_count <= {SMALL_TABLE_ROWS} then 'ALL' "
                f"when best.ratio >= {HIGH_CARDINALITY}D then 'KEY' else 'EVEN' end"
            ),
        )
        .selectExpr(
            "table_name",
            "row_count",
            "diststyle",
            "case when diststyle = 'KEY' then best.name end as distkey",
            f"case when diststyle = 'ALL' then {small} when diststyle = 'KEY' then {keyed} "
            f"when best.ratio < {SKEWED_CARDINALITY}D then {skewed} else {neither} end as dist_rationale",
            "case diststyle when 'ALL' then 'broadcast' "
            "when 'KEY' then concat('partition by hash of ', best.name) else 'rebalance evenly' end "
            "as spark_action",
            "lengths",
        )
    )


def sort_advice(usage: Usage) -> SortAdvice:
    """A range filter leads; three or more equality filters share the order; fewer are taken as given."""
    equal = usage.equality_filters
    # The wording of the advice.
    if usage.range_filter:
        columns = (usage.range_filter, *equal[:1])
        tail = f", {equal[0]} is the next most common equality filter." if equal else "."
        lead = f"{usage.range_filter} is the dominant range filter (leading column)"
        return SortAdvice(columns, "COMPOUND", f"COMPOUND SORTKEY({', '.join(columns)}): {lead}{tail}")
    if len(equal) >= 3:
        return SortAdvice(
            equal,
            "INTERLEAVED",
            f"INTERLEAVED SORTKEY: filter pattern varies across {len(equal)} unrelated columns with no "
            "single dominant one -- costs more to VACUUM REINDEX than a compound key.",
        )
    if equal:
        columns = equal[:2]
        return SortAdvice(
            columns, "COMPOUND", f"COMPOUND SORTKEY({', '.join(columns)}): the declared equality filters."
        )
    return SortAdvice((), "COMPOUND", "No SORTKEY recommended -- no declared filter pattern for this table.")


def usage_of(table: str, usages: dict[str, Usage]) -> Usage:
    if table not in usages:
        raise ValueError(f"no usage profile declared for {table}")
    return usages[table]


def gather(tables: dict[str, DataFrame], usages: dict[str, Usage], approx: bool = False, in_bytes: bool = False) -> DataFrame:
    """The stats rows of several tables; a table without a usage profile is an error."""
    rows = [
        table_stats(df, name, usage_of(name, usages).join_keys, approx, in_bytes) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def advise(stats: DataFrame, usages: dict[str, Usage]) -> DataFrame:
    """The recommendation that follows from each stats row."""
    sorts = {table: sort_advice(usage) for table, usage in usages.items()}
    entries = ", ".join(
        f"{sql_text(table)}, named_struct('columns', array({', '.join(map(sql_text, s.columns))}), "
        f"'style', {sql_text(s.style)}, 'rationale', {sql_text(s.rationale)})"
        for table, s in sorts.items()
    )
    return (
        distribution(stats)
        .withColumn("sort", F.expr(f"element_at(map({entries}), table_name)"))
        .selectExpr(
            "table_name",
            "row_count",
            "diststyle",
            "distkey",
            "cast(sort.columns as array<string>) as sortkey_columns",
            "sort.style as sortkey_type",
            "array(dist_rationale, sort.rationale) as rationale",
            "spark_action",
            "lengths",
        )
    )


def recommend(df: DataFrame, table: str, usages: dict[str, Usage], approx: bool = False) -> DataFrame:
    """The recommendation for one table, as one row."""
    return layout_report({table: df}, usages, approx)


def layout_report(tables: dict[str, DataFrame], usages: dict[str, Usage], approx: bool = False) -> DataFrame:
    """One recommendation per table: every table is read once, the rules run over the stats rows."""
    return advise(gather(tables, usages, approx), usages).drop("lengths")
