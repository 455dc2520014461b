"""What the operators share: the registry, the given tables, Arrow settings and walks over texts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dimflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

#: How much text one Arrow batch may carry, so that a worker's memory does not depend on text lengths.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
#: Bytes of text that are worked on at once inside a batch.
SLICE_BYTES = 2 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings and bounded Arrow batches."""
    configure(spark)
    for name, value in ARROW.items():
        spark.conf.set(name, value)
    return spark


def query(build: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)

    REGISTRY[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow text column and its offsets; a null text has no bytes."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return bytes_, bounds


def slices(sizes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of consecutive rows with about ``most`` bytes each; a longer row is a run of its own."""
    totals = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(totals, totals[at] + most, "right")) - 1)
        yield at, end
        at = end


def give_back() -> None:
    """Return what this Python worker has freed to the system; Arrow's pool and glibc keep it for later otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
