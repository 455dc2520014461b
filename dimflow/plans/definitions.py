"""Table definitions for the target warehouse, from a table's schema and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.names import sql_text
from dimflow.plans.layout import Usage, advise, gather, sort_advice, table_stats

# The target's type names, and the least width of a text column.
TARGET_TYPES = {
    T.LongType(): "BIGINT",
    T.IntegerType(): "INTEGER",
    T.DoubleType(): "DOUBLE PRECISION",
    T.BooleanType(): "BOOLEAN",
    T.DateType(): "DATE",
    T.TimestampType(): "TIMESTAMP",
    T.TimestampNTZType(): "TIMESTAMP",
}
LEAST_WIDTH = 16


def target_type(field: T.StructField) -> str:
    """The target type of a column, as SQL over its stats row.

    Text gets twice its longest value and at least 16; decimals and unknown types keep their name.
    """
    if isinstance(field.dataType, T.StringType):
        return f"concat('VARCHAR(', greatest({LEAST_WIDTH}, 2 * lengths[{sql_text(field.name)}]), ')')"
    return sql_text(TARGET_TYPES.get(field.dataType, field.dataType.simpleString().upper()))


def column_profile(df: DataFrame, table: str, in_bytes: bool = False) -> DataFrame:
    """One row per column with its target type; all text widths come from one pass, in characters or bytes."""
    columns = [
        f"named_struct('position', {i}, 'column_name', {sql_text(f.name)}, 'target_type', {target_type(f)})"
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return table_stats(df, table, in_bytes=in_bytes).selectExpr("table_name", f"inline(array({', '.join(columns)}))")


def create_tables(
    tables: dict[str, DataFrame], usages: dict[str, Usage], schema: str = "analytics", approx: bool = False,
    in_bytes: bool = False,
) -> DataFrame:
    """One row per table: the create-table statement, with distribution and sort clauses.

    Row count, distinct counts and text widths of a table come from one pass over it.
    """
    bodies, sorts = [], []
    for name, df in tables.items():
        lines = [f"concat({sql_text(f'    {f.name} ')}, {target_type(f)})" for f in df.schema.fields]
        bodies.append(f"when {sql_text(name)} then concat_ws(',\\n', {', '.join(lines)})")
        sort = sort_advice(usages[name]) if name in usages else None
        order = f"\n{sort.style} SORTKEY({', '.join(sort.columns)})" if sort and sort.columns else ""
        sorts.append(f"when {sql_text(name)} then {sql_text(order)}")
    advice = advise(gather(tables, usages, approx, in_bytes), usages)
    return advice.select(
        "table_name",
        F.expr(
            f"concat({sql_text(f'CREATE TABLE {schema}.')}, table_name, ' (\\n', case table_name {' '.join(bodies)} end, '\\n)', "
            "case when distkey is not null then concat('\\nDISTKEY(', distkey, ')') "
            "else concat('\\nDISTSTYLE ', diststyle) end, "
            f"case table_name {' '.join(sorts)} end, ';\\n')"
        ).alias("create_table"),
    )


def load_statement(table: str, location: str, role: str, schema: str = "analytics") -> str:
    """The statement that loads an exported table into the target."""
    return (
        f"COPY {schema}.{table}\nFROM '{location.rstrip('/')}/{table}/'\n"
        f"IAM_ROLE '{role}'\nFORMAT AS PARQUET;\n"
    )
