"""Keyed upserts driven by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from dimflow.registry import TableSpec
from dimflow.sources.store import Store

#: Spark's local property with the id a streaming query keeps over restarts from its checkpoint.
_QUERY = "sql.streaming.queryId"


def upsert_stream(
    stream: DataFrame, store: Store, layer: str, spec: TableSpec, checkpoint: str, **trigger
) -> StreamingQuery:
    """Upsert every micro-batch into a stored table, exactly once.

    The checkpoint takes the place of the high-water mark as the record of what has been read. The commit of a
    micro-batch holds the query's id and the batch's number, so one replayed after a failure is not even read; a query
    that lost its checkpoint has a new id and writes its batches again, which changes nothing, as the
    upsert is idempotent. By default all data at hand is processed and the query ends.
    """

    def commit(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(_QUERY)
        given = (query, number) if query else None
        Store(batch.sparkSession, store.root).upsert(layer, spec, batch, stream=given)

    return (
        stream.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
