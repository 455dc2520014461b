"""Run the query catalogue beside its SQL: ``python -m tests.compare /root/testdata/sf0.01 [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def local_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _value(value):
    return str(value) if isinstance(value, Decimal) else value


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(_value(row[c]) for c in columns) for row in df.select(*columns).collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(_value(row[i]) for i in order) for row in result.fetchall())
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; only here {list((got - want).items())[:2]}; "
        f"only in SQL {list((want - got).items())[:2]}"
    )


def main() -> int:
    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con, failed = local_session(), duck(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in only or queries():
        start = time.time()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as error:  # report every query, whatever one of them does
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        checked = "ok" if name in oracle_sql() else "ran"
        print(f"{time.time() - start:6.2f}s {name}: {found or checked}", flush=True)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
