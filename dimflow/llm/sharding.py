"""Contiguous shards of nearly equal bytes, from global prefix sums of sizes.

Documents are range-partitioned and sorted by id. Each partition sums its own sizes; the partitions' totals,
one pair of numbers for each, give every partition its place among all bytes and rows. A document belongs to the
shard in whose equal stretch of all bytes its first byte lies. Texts are never moved: only ids, sizes and checksums are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import query, table
from dimflow.session import materialise

SHARDS = 40
OVERHEAD = 16


def sharded(docs: DataFrame, id_col: str, text_col: str, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """``id_col`` (long), ``size``, ``text_crc32``, ``shard`` and ``slot`` (from 0, without gaps) of each document.

    A size is the UTF-8 bytes of the text, none for a null one, and ``overhead``. Shards are in the order of
    ids, null ids first, equal ids by checksum and size; no shard's bytes are further from its share than its last
    document and that of the shard before reach. Repeated rows each have a slot. Equal texts are not kept
    together: a copied text may hold more bytes than a shard. Other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("crc")
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, n = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            ends = total + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(ends - sizes), pa.array(np.arange(n, n + len(sizes)))],
                names=["id", "size", "crc", "part", "before", "row"],
            )
            total, n = int(ends[-1]) if len(ends) else total, n + len(sizes)

    order = [F.col("id").asc_nulls_first(), F.col("crc"), F.col("size")]
    sorted_ = materialise(rows, "sizes").repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialise(sorted_.mapInArrow(placed, "id long, size long, crc long, part int, before long, row long"), "prefix")
    totals = local.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    parts = max((t.part for t in totals), default=-1) + 1
    held = {t.part: t for t in totals}
    bytes_of, rows_of = ([held[p][c] if p in held else 0 for p in range(parts)] for c in ("bytes", "n"))
    everything = max(1, sum(bytes_of))

    def base(numbers: list[int]) -> F.Column:
        """A partition's start, read from one text literal however many partitions there are."""
        starts = F.split(F.lit(",".join(map(str, accumulate(numbers[:-1], initial=0)))), ",").cast("array<bigint>")
        return F.get(starts, F.col("part"))

    begin = (base(bytes_of) + F.col("before")).cast("decimal(38,0)")
    shard = F.least(F.floor(begin * shards / everything), F.lit(shards - 1)).cast("int")
    numbered = local.select("id", "size", "crc", shard.alias("shard"), (base(rows_of) + F.col("row")).alias("place"))
    firsts = materialise(numbered.groupBy("shard").agg(F.min("place").alias("first")), "first-rows")
    return numbered.join(firsts, "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def write_shards(docs: DataFrame, id_col: str, text_col: str, path: str, shards: int = SHARDS) -> None:
    """The rows of ``docs`` in one folder for each shard, sorted by slot.

    Ids must be unique and not null, as rows and places meet by them; others are an error before anything is written.
    """
    twice = docs.groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR _id IS NULL").first()
    if twice:
        raise ValueError(f"{id_col} {twice['_id']} is null or there more than once")
    places = sharded(docs, id_col, text_col, shards).select(F.col(id_col).alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    rows = docs.join(places, F.col(f"`{id_col}`") == F.col("_id")).drop("_id")
    rows.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").drop("_slot").write.partitionBy("_shard").parquet(path)


@query
def op9_byte_shards(spark, sf_dir):
    places = sharded(table(spark, sf_dir, "documents"), "doc_id", "text")
    return places.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
