"""Statistics kept beside a stored table: a mergeable sketch for each of its directories.

A load adds or rewrites some directories and leaves the others, so only those are read; advice merges what is kept
and scans no table. Distinct counts are HyperLogLog sketches, widths are exact, and both merge without loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.names import sql_name, sql_text
from dimflow.plans.layout import STATS_SCHEMA, text_columns
from dimflow.registry import TableSpec
from dimflow.sources.store import Store

#: 2 to this number of registers; the standard error of a count is then about 0.8 per cent.
LOG_REGISTERS = 14
_PLACE = r"((gen|kept)=[0-9]+(/_b=-?[0-9]+)?)/[^/]*$"


def sketched(df: DataFrame, by: str, keys: tuple[str, ...]) -> DataFrame:
    """``by`` with its row count, a sketch of each key's distinct values, and the longest text of each text column."""
    sketches = [f"{sql_text(k)}, hll_sketch_agg(cast({sql_name(k)} as string), {LOG_REGISTERS})" for k in keys]
    lengths = [f"{sql_text(t)}, coalesce(max(length({sql_name(t)})), 0)" for t in text_columns(df.schema) if t != by]
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.expr(f"map({', '.join(sketches)})").cast("map<string,binary>").alias("distincts"),
        F.expr(f"map({', '.join(lengths)})").cast("map<string,int>").alias("lengths"),
    )


def refresh(store: Store, layer: str, table: str, keys: tuple[str, ...]) -> int:
    """Sketch the directories of a stored table that have none yet, drop those of directories that went; how many were read.

    A table is sketched for one set of keys: another one sketches all of it again.
    """
    spec = TableSpec(f"{table}_sketches", ("place",), buckets=1, unique=True)
    places = store.places(layer, table)
    known = store.find(layer, spec.name)
    # One name for each directory of the table.
    have = {r.place: set(r.names) for r in known.select("place", F.map_keys("distincts").alias("names")).collect()} if known is not None else {}
    fresh = [p for p in places if have.get(p) != set(keys)]
    gone = [(p,) for p in have if p not in places]
    if not fresh and not gone:
        return 0
    rows = store.read_places(layer, table, fresh).withColumn("place", F.regexp_extract(F.col("_metadata.file_path"), _PLACE, 1))
    made = sketched(rows, "place", keys)
    out = store.spark.createDataFrame(gone, "place string").join(known, "place") if gone else None
    store.upsert(layer, spec, made, gone=out)
    return len(fresh)


def kept_stats(store: Store, layer: str, table: str, keys: tuple[str, ...]) -> DataFrame:
    """What ``layout.table_stats`` gives, with approximate distinct counts, merged from the kept sketches."""
    kept = store.read(layer, f"{table}_sketches")
    schema = store.commit(layer, table).schema
    distincts = [
        f"named_struct('position', {i}, 'name', {sql_text(k)}, 'n', "
        f"coalesce(hll_sketch_estimate(hll_union_agg(distincts[{sql_text(k)}])), 0))"
        for i, k in enumerate(keys)
    ]
    lengths = [f"{sql_text(t)}, coalesce(max(lengths[{sql_text(t)}]), 0)" for t in text_columns(schema)]
    return kept.agg(
        F.expr("coalesce(sum(row_count), 0)").cast("bigint").alias("row_count"),
        F.expr(f"array({', '.join(distincts)})").alias("distincts"),
        F.expr(f"map({', '.join(lengths)})").cast("map<string,int>").alias("lengths"),
    ).select(F.lit(table).alias("table_name"), "*").to(T.StructType.fromDDL(STATS_SCHEMA))
