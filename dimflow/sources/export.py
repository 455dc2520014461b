"""Curated exports as Parquet, laid out the way the layout advice says."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.names import sql_name
from dimflow.plans.layout import Usage, sort_advice

_PLACE = "_place"
_BITS = 63  # of a place, shared out among the columns' ranks
_MOST_BITS = 5  # of one column's rank


def ordinal(df: DataFrame, column: str) -> Column:
    """A number in the order of a column's values. Of a text it is the first six bytes, so longer ones may share one."""
    kind, value = df.schema[column].dataType, F.col(sql_name(column))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("double")
    first = F.rpad(F.hex(F.substring(value.cast("string").cast("binary"), 1, 6)), 12, "0")
    return F.conv(first, 16, 10).cast("double")


def interleaved(df: DataFrame, columns: list[str]) -> Column:
    """A row's place on a space-filling curve that gives every column the same say: the bits of their ranks in turn.

    A rank is how many of the column's quantiles a value reaches, so ranks are spread evenly whatever the values' distribution, and
    rows that are near on the curve are near in every column: files have narrow ranges of each. All quantiles come from
    one pass, one row of at most 31 numbers for each column. NULL ranks lowest. Of more than 63 columns the first 63
    take part, with a bit each; those after them only order the rows within a place.
    """
    columns = columns[:_BITS]
    each = min(_MOST_BITS, _BITS // len(columns))
    shares = [(i + 1) / (1 << each) for i in range((1 << each) - 1)]
    wanted = [F.percentile_approx(ordinal(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]
    quantiles = df.agg(*wanted).first()
    ranks = []
    for i, column in enumerate(columns):
        value, cuts = ordinal(df, column), quantiles[i] or []
        ranks.append(reduce(lambda a, b: a + b, [F.coalesce(value >= q, F.lit(False)).cast("long") for q in cuts], F.lit(0).cast("long")))
    bits = []
    for bit in range(each):
        for i, rank in enumerate(ranks):
            taken = F.shiftright(rank, each - bit - 1).bitwiseAND(F.lit(1))
            bits.append(F.shiftleft(taken, (each - bit) * len(columns) - i - 1))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def laid_out(df: DataFrame, usage: Usage) -> DataFrame:
    """The table partitioned and sorted by its sort advice.

    The hash of the whole row follows the sort columns in the partitioning, so that rows sharing a
    sort value, however many, are still spread over tasks. Without advice, files are evened out only.
    """
    advice = sort_advice(usage)
    columns = list(advice.columns)
    if not columns:
        return df.hint("rebalance")
    if advice.style == "INTERLEAVED":
        placed = df.withColumn(_PLACE, interleaved(df, columns))
        order = [_PLACE, *columns]
    else:
        placed, order = df, columns
    spread = placed.repartitionByRange(*order, F.xxhash64(*[F.col(c) for c in df.columns]))
    return spread.sortWithinPartitions(*order).select(*df.columns)


def write_export(df: DataFrame, location: str, table: str, usage: Usage) -> str:
    """Write a table to ``<location>/<table>/``, the place its load statement reads, replacing what is there.

    Columns compared for equality get Bloom filters, which let a reader skip row groups.
    """
    path = f"{location.rstrip('/')}/{table}/"
    writer = laid_out(df, usage).write.mode("overwrite")
    for column in usage.equality_filters:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    return path


def write_statements(statements: DataFrame, location: str) -> None:
    """Write one text file per table definition, as ``<location>/table_name=<table>/``."""
    lines = F.rtrim(F.col("create_table"), F.lit("\n")).alias("value")  # the sink ends them itself
    statements.select("table_name", lines).write.mode("overwrite").partitionBy("table_name").text(location)
