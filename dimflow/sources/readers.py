"""Source tables as DataFrames. Filters and column choices made on them reach the source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Source = Callable[[str], DataFrame]


def parquet_source(
    spark: SparkSession, folder: str, schemas: dict[str, str] | None = None, suffix: str = ".parquet"
) -> Source:
    """Tables as Parquet under one folder; a table with a declared schema is read without a look at its files."""

    def read(name: str) -> DataFrame:
        reader = spark.read if schemas is None or name not in schemas else spark.read.schema(schemas[name])
        return reader.parquet(f"{folder}/{name}{suffix}")

    return read


def jdbc_source(
    spark: SparkSession,
    url: str,
    properties: dict[str, str] | None = None,
    partitioning: dict[str, tuple[str, str, str, int]] | None = None,
) -> Source:
    """Tables of a database. ``partitioning`` gives (column, lower, upper, partitions) per large table.

    Without it a table is read by one task, so every large table needs an entry.
    """

    def read(name: str) -> DataFrame:
        options = {**(properties or {}), "url": url, "dbtable": name}
        if partitioning and name in partitioning:
            column, lower, upper, partitions = partitioning[name]
            options |= {
                "partitionColumn": column,
                "lowerBound": lower,
                "upperBound": upper,
                "numPartitions": str(partitions),
            }
        return spark.read.format("jdbc").options(**options).load()

    return read
