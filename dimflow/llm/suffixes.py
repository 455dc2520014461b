"""Passages that repeat across documents, by a depth-limited radix sort of suffixes.

The suffixes are those of all texts, one for each byte that has ``threshold`` bytes from it on. They are
ordered by their first ``threshold`` bytes only, digit by digit, the most significant first; after each pass
a suffix that is alone in its group is finished, and the groups left after the last digit are exactly the repeated
windows. Equal windows are equal in any digit made of their bytes alone, so the digits are taken where they
separate most for the least moved:

1. The anchor: of the grams of half the threshold in the window, the one of least hash, the leftmost of equals.
   Neighbouring suffixes mostly share it, so they travel as one run, one row for about a quarter of the threshold.
2. All bytes of the run. Equal runs are repeated as a whole; one of them stands for all from here on.
3. For runs that share their anchor with a different run, eight suffixes at a time: the bytes that all eight share.
4. All bytes that any of the eight has.
5. The window's own bytes, suffix by suffix, for the eights that share digit 3 with different ones.

Rows of a pass are counted with partials before they move, and a group is never brought together, so
a passage that a third of all documents share costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import SLICE_BYTES, query, table, text_buffer
from dimflow.session import materialise

THRESHOLD = 400
PIECE = 1 << 20  # windows worked on at once, at most 2^21 less the threshold
_PLACE = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2^64
_STEP = 8

#: Suffixes ``lo`` to ``lo + n - 1`` of a text, its anchor, and two digits; the second contains the first.
_CUTS = "row long, lo int, n int, anchor int, ax long, ay long, bx long, by long"
_NAMES = [c.split()[0] for c in _CUTS.split(", ")]


def _mixed(values: np.ndarray) -> np.ndarray:
    for factor, shift in ((0xBF58476D1CE4E5B9, 30), (0x94D049BB133111EB, 27)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=24)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and the powers of the base and of its inverse."""
    of_byte = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    up, down = (np.cumprod(np.full(n, b, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return of_byte, up, down


def anchors(data: np.ndarray, gram: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``threshold`` bytes the place and the hash of its anchor."""
    of_byte, up, down = _powers(1 << (len(data) - 1).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(of_byte[data] * up[: len(data)])])
    hashes = _mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    # The place in the low bits makes the least of all the leftmost of equals.
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    wide, seen = threshold - gram + 1, 1
    while seen < wide:
        step = min(seen, wide - seen)
        least = np.minimum(least[:-step], least[step:])
        seen += step
    places = (least & _PLACE).astype(np.int64)
    return places, hashes[places]


def digests(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """128 bits of each stretch of bytes, as two numbers."""
    raw = memoryview(np.ascontiguousarray(data))
    made = [blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist())]
    pairs = np.frombuffer(b"".join(made), np.int64).reshape(-1, 2)
    return [pairs[:, 0], pairs[:, 1]]


def runs_of(data: np.ndarray, bounds: np.ndarray, threshold: int, piece: int = PIECE) -> Iterator[list[np.ndarray]]:
    """Row number, first suffix, number of suffixes, anchor, its hash, and digests of each run, piece by piece.

    Suffixes that share an anchor are a run; a run ends with its text, and where a piece ends.
    """
    gram, end = max(1, threshold // 2), int(bounds[-1])
    for at in range(int(bounds[0]), end - threshold + 1, piece):
        places, hashes = anchors(data[at : min(at + piece + threshold - 1, end)], gram, threshold)
        starts = np.arange(at, at + len(places))
        rows = np.searchsorted(bounds, starts, "right") - 1
        whole = np.flatnonzero(starts + threshold <= bounds[rows + 1])
        if len(whole):
            rows, places, starts, hashes = rows[whole], places[whole] + at, starts[whole], hashes[whole]
            first = _changes(rows, places)
            n = np.diff(np.append(first, len(rows)))
            rows, starts, begin = rows[first], starts[first], bounds[rows[first]]
            yield [rows, starts - begin, n, places[first] - begin, hashes[first].view(np.int64),
                   *digests(data, starts, starts + n - 1 + threshold)]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before, the first row included."""
    return np.append(0, np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], 0)) + 1)


def cuts_of(text: np.ndarray, lo: np.ndarray, n: np.ndarray, anchor: np.ndarray, step: int, threshold: int) -> list[np.ndarray]:
    """Runs cut by ``step`` suffixes, with a digest of what all of a step share and one of what any has.

    Steps are counted from the anchor, so equal windows are at the same place of theirs. What a step shares does
    not depend on how much of it the run has.
    """
    run = np.repeat(np.arange(len(lo)), n)
    each = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + lo[run]
    steps = (anchor[run] - each) // step
    first = _changes(run, steps)
    lo, n, anchor = each[first], np.diff(np.append(first, len(run))), anchor[run[first]]
    shared = anchor - steps[first] * step
    a = digests(text, shared, shared + threshold - step + 1)
    return [lo, n, anchor, *a, *(a if step == 1 else digests(text, lo, lo + n - 1 + threshold))]


def packed(docs: DataFrame, kind: str) -> DataFrame:
    """``row``, ``id``, ``n_bytes`` and the text compressed, as it is moved more than once and read in Python only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            data, bounds = text_buffer(batch.column(2))
            texts = [pack(data[a:b].tobytes()) for a, b in pairwise(bounds.tolist())]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(bounds)), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "n_bytes", "text"])

    return docs.mapInArrow(work, f"row long, id {kind}, n_bytes long, text binary")


def unpacked(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts of a batch some at a time: the first row and the one after the last, the bytes, and where each begins."""
    unpack, texts, first, held = zstandard.ZstdDecompressor().decompress, [], 0, 0
    raws = batch.column(column)
    for at in range(len(raws)):
        texts.append(unpack(raws[at].as_buffer()))
        held += len(texts[-1])
        if held >= most or at == len(raws) - 1:
            yield first, at + 1, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
            texts, first, held = [], at + 1, 0


def _runs(texts: DataFrame, threshold: int, piece: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, bounds in unpacked(batch, 1):
                for rows, lo, n, anchor, gram, x, y in runs_of(data, bounds, threshold, piece):
                    columns = [ids[first + rows], *(c.astype(np.int32) for c in (lo, n, anchor)), gram, np.zeros_like(gram), x, y]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_NAMES)

    return texts.where(F.col("n_bytes") >= threshold).select("row", "text").mapInArrow(work, _CUTS)


def _cuts(texts: DataFrame, undecided: DataFrame, step: int, threshold: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, asked = batch.column(0).to_pylist(), batch.column(2)
            for first, end, data, bounds in unpacked(batch, 1):
                for i in range(first, end):
                    lo, n, anchor = (asked[i].values.field(k).to_numpy().astype(np.int64) for k in range(3))
                    *places, ax, ay, bx, by = cuts_of(data[bounds[i - first] : bounds[i - first + 1]], lo, n, anchor, step, threshold)
                    columns = [np.full(len(ax), rows[i]), *(c.astype(np.int32) for c in places), ax, ay, bx, by]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_NAMES)

    # Written, its size is known: texts move only if it is too large to broadcast.
    asked = materialise(undecided.groupBy("row").agg(F.collect_list(F.struct("lo", "n", "anchor")).alias("runs")), "undecided")
    return texts.join(asked, "row").select("row", "text", "runs").mapInArrow(work, _CUTS)


def _pass(cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Order by both digits: what is repeated as a whole, and one of each of the rest whose group is larger than itself."""
    cuts = materialise(cuts, "suffixes")
    first, both = ["ax", "ay"], ["ax", "ay", "bx", "by"]
    shared = materialise(cuts.groupBy(*first).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*first), "digits")
    alive = materialise(cuts.join(shared, first, "left_semi"), "alive")
    kinds = alive.groupBy(*both).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("row", "lo", "n", "anchor")).alias("one"))
    kinds = materialise(kinds, "kinds")
    repeated = alive.join(kinds.where("_n > 1").select(*both), both, "left_semi").select("row", "lo", "n")
    several = kinds.groupBy(*first).agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select(*first)
    several = materialise(several, "several")  # so that the join starts from plain shuffles, and a hot digit can be split
    return repeated, kinds.join(several, first, "left_semi").select("one.*")


def _merged(spans: DataFrame, threshold: int) -> DataFrame:
    """For each row its maximal stretches that repeated windows cover."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for group in batch.column(1):
                lo, n = (group.values.field(k).to_numpy().astype(np.int64) for k in range(2))
                order = np.argsort(lo, kind="stable")
                lo, reach = lo[order], np.maximum.accumulate((lo + n - 1 + threshold)[order])
                new = np.append(0, np.flatnonzero(lo[1:] > reach[:-1]) + 1)
                ends = reach[np.append(new[1:] - 1, len(reach) - 1)]
                found.append([{"start": a, "end": b} for a, b in zip(lo[new].tolist(), ends.tolist())])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["row", "spans"])

    grouped = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "n")).alias("all"))
    return grouped.mapInArrow(work, "row long, spans array<struct<start:long,end:long>>")


def without_repeats(docs: DataFrame, id_col: str, text_col: str, threshold: int = THRESHOLD, piece: int = PIECE) -> DataFrame:
    """``id_col``, ``n_bytes``, ``spans`` and ``kept`` for each document.

    ``spans`` are the maximal stretches of UTF-8 bytes (``start`` inside, ``end`` outside) covered by strings of
    ``threshold`` bytes that start anywhere else too, in the same document or another; ``kept`` are the other bytes
    (binary, as a cut may fall inside a character). Windows are judged on the texts as given, and never
    cross documents. Null and empty texts have no bytes and no spans. Each row is a document of its own whatever its
    id, so a text that is there twice repeats as a whole; null ids are kept; other columns are not read. An empty
    table gives an empty result.
    """
    if threshold < 2:
        raise ValueError("a window has two bytes or more")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["id"].dataType
    rows = materialise(packed(rows, kind.simpleString()), "texts")  # which fixes the row numbers
    texts = rows.select("row", "n_bytes", "text")
    repeated, undecided = _pass(_runs(texts, threshold, piece))
    spans = repeated
    for step in (max(1, min(_STEP, threshold // 2)), 1):
        repeated, undecided = _pass(_cuts(texts, undecided, step, threshold))
        spans = spans.unionAll(repeated)
    spans = materialise(_merged(spans, threshold), "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_spans = batch.column(2).to_pylist()
            for first, end, data, bounds in unpacked(batch, 1):
                kept = []
                for spans, a, b in zip(all_spans[first:end], bounds[:-1], bounds[1:]):
                    text = data[a:b].tobytes()
                    ends = [0, *(s["end"] for s in spans)]
                    kept.append(b"".join(text[x:y] for x, y in zip(ends, [*(s["start"] for s in spans), len(text)])))
                part = [c.slice(first, end - first) for c in (batch.column(0), batch.column(2))]
                columns = [part[0], pa.array(np.diff(bounds)), part[1], pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "spans", "kept"])

    none = F.array().cast(spans.schema["spans"].dataType)
    given = rows.join(spans, "row", "left").select("id", "text", F.coalesce("spans", none).alias("spans"))
    schema = f"id {kind.simpleString()}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return given.mapInArrow(work, schema).withColumnRenamed("id", id_col)


@query
def op13_repeated_passages(spark, sf_dir):
    found = without_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
