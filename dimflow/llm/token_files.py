"""Token ids of all documents in Huffman-coded files, in ascending order of the documents' ids.

A file is a header (magic, code lengths), blocks of whole documents, and a footer: an index of the
blocks and its length. A block holds the document ids, their token counts, the checkpoints and the coded
ids; any block is decoded alone, with the header. One file comes from one range of document ids. Files
are numbered in that order and a block knows where it starts within its file, so where a document starts among
all is known from the files' totals, one number for each.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm import files
from dimflow.llm.common import query, slices, table, text_buffer
from dimflow.llm.huffman import LIMIT, Code, code_lengths
from dimflow.llm.pieces import Memo
from dimflow.llm.token_counts import load_tokenizer
from dimflow.session import fresh_path, materialise

MAGIC = b"HUFIDS1\0"
BLOCK_IDS = 1 << 16
LINE = 256  # words that go to the library in one text
_NO_ID = 1  # flag of a document without an id
_MANIFEST = "file string, part int, block int, offset long, length long, first long, n_ids long"


class Encoder:
    """Ids of texts under a tokenizer that drops white space, lower-cases, and never looks across white space.

    Texts are cut into words, and each word is encoded once. Words of letters go to the library many at a time:
    each gives one id that ends a word, its last, so the ids of all are cut there.
    """

    def __init__(self, path: str, dtype: str) -> None:
        tokenizer = load_tokenizer(path)
        suffix = tokenizer.model.end_of_word_suffix
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        if suffix:
            ends[[number for word, number in tokenizer.get_vocab().items() if word.endswith(suffix)]] = True

        def whole(keys: list[bytes]) -> list[bytes]:
            found = tokenizer.encode_batch_fast([k.decode() for k in keys], add_special_tokens=False)
            return [np.array(e.ids, dtype).tobytes() for e in found]

        def joined(keys: list[bytes]) -> list[bytes]:
            lines = [b" ".join(keys[i : i + LINE]).decode() for i in range(0, len(keys), LINE)]
            found = tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in found), dtype)
            cuts = np.flatnonzero(ends[ids]) + 1
            # Each word ends at least once; as many ends as words are one for each.
            if len(cuts) != len(keys) or len(keys) and cuts[-1] != len(ids):
                return whole(keys)
            raw, at = ids.tobytes(), (cuts * ids.itemsize).tolist()
            return [raw[a:b] for a, b in pairwise([0, *at])]

        def plain(keys: list[bytes]) -> list[bytes]:
            easy = [k.decode().isalpha() for k in keys]
            fast, slow = iter(joined([k for k, e in zip(keys, easy) if e])), iter(whole([k for k, e in zip(keys, easy) if not e]))
            return [next(fast if e else slow) for e in easy]

        self.memo = Memo(plain, most=40 << 20)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
        """Each text's ids. A-Z are lower-cased first, unless that could make a special string."""
        data, bounds = parted(data[bounds[0] : bounds[-1]], bounds - bounds[0])
        texts = []
        for i in range(len(bounds) - 1):
            text = data[bounds[i] : bounds[i + 1]].tobytes()
            texts.append((text if b"<|" in text else text.lower()).split())
        self.memo.learn(word for words in texts for word in words)
        lookup = self.memo.known.__getitem__
        for words in texts:
            yield b"".join(map(lookup, words))


def parted(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A blank put before each stop or comma that follows a small letter and precedes white space.

    Such a mark is a token by itself, so the ids stay the same and the word before it is a word seen more often.
    """
    at = np.flatnonzero((data[1:-1] == 44) | (data[1:-1] == 46)) + 1
    before, after = data[at - 1], data[at + 1]
    at = at[(before >= 97) & (before <= 122) & ((after == 32) | (after == 10))]
    at = at[~np.isin(at, bounds) & ~np.isin(at + 1, bounds)]
    return np.insert(data, at, 32), bounds + np.searchsorted(at, bounds)


@lru_cache(maxsize=1)
def encoder(path: str, dtype: str) -> Encoder:
    """One for all tasks of a Python worker, so that words learnt in one task are known in the next."""
    return Encoder(path, dtype)


def tokenised(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, dtype: str) -> DataFrame:
    """``doc_id`` (long) and ``ids``, the end id included, for each document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, dtype), np.array([end_id], dtype).tobytes()
        for batch in batches:
            data, bounds = text_buffer(batch.column(1))
            ids = [x + end for a, b in slices(np.diff(bounds)) for x in encode(data, bounds[a : b + 1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(work, "doc_id long, ids binary")


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column in one array, and where each row begins and the last one ends."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def id_counts(tokens: DataFrame, dtype: str, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all documents; one number per id reaches the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            data, bounds = _bytes_of(batch.column(0))
            for a, b in slices(np.diff(bounds)):
                total += np.bincount(data[bounds[a] : bounds[b]].view(dtype), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["id", "n"])

    summed = tokens.select("ids").mapInArrow(work, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for row in summed.collect():
        counts[row.id] = row.n
    return counts


def _block(code: Code, docs: list[int | None], ids: list[np.ndarray]) -> bytes:
    joined = np.concatenate(ids)
    words, checkpoints = code.encode(joined)
    flags = np.array([d is None for d in docs], np.uint8) * _NO_ID
    head = struct.pack("<IIII", len(docs), len(joined), len(checkpoints), len(words))
    return b"".join([
        head, np.array([d or 0 for d in docs], "<i8").tobytes(), np.array([len(x) for x in ids], "<u4").tobytes(),
        checkpoints.tobytes(), words.tobytes(), flags.tobytes(),
    ])


def read_block(raw: bytes, code: Code) -> tuple[list[int | None], list[np.ndarray]]:
    """The documents of a block and the ids of each."""
    n_docs, n_ids, n_checks, n_words = struct.unpack_from("<IIII", raw)
    at, parts = 16, []
    for kind, n in (("<i8", n_docs), ("<u4", n_docs), ("<u4", n_checks), ("<u4", n_words), ("u1", n_docs)):
        parts.append(np.frombuffer(raw, kind, n, at))
        at += parts[-1].nbytes
    names, sizes, checkpoints, words, flags = parts
    ids = code.decode(words, checkpoints, n_ids)
    docs = [None if f & _NO_ID else int(d) for d, f in zip(names, flags)]
    return docs, np.split(ids, np.cumsum(sizes, dtype=np.int64)[:-1]) if n_docs else []


def write_files(tokens: DataFrame, lengths: np.ndarray, folder: str, dtype: str) -> DataFrame:
    """Write the files, one for each range of ``doc_id``; the manifest has a row for each block."""
    header = zlib.compress(lengths.tobytes())
    header = MAGIC + struct.pack("<II", len(lengths), len(header)) + header

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code.of(lengths), TaskContext.get().partitionId()
        sink, name, rows = None, files.fresh_name(folder, f"ids-{part:06d}", ".huf"), []
        docs, ids, held, first, offset = [], [], 0, 0, len(header)

        def flush() -> None:
            nonlocal docs, ids, held, first, offset
            raw = _block(code, docs, ids)
            sink.write(raw)
            rows.append((name, part, len(rows), offset, len(raw), first, held))
            docs, ids, held, first, offset = [], [], 0, first + held, offset + len(raw)

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if sink is None:
                    sink = files.create(name)
                    sink.write(header)
                docs.append(doc)
                ids.append(np.frombuffer(raw.as_py(), dtype))
                held += len(ids[-1])
                if held >= BLOCK_IDS:
                    flush()
        if sink is None:
            return
        if docs:
            flush()
        footer = np.array([r[3:] for r in rows], "<i8").tobytes()
        sink.write(footer + struct.pack("<I", len(rows)) + MAGIC)
        sink.close()
        columns = [pa.array(c) for c in zip(*rows)]
        names = [c.split()[0] for c in _MANIFEST.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names=names)

    order = [F.col("doc_id").asc_nulls_first(), F.crc32("ids")]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ordered.mapInArrow(work, _MANIFEST), "token-files")


def read_lengths(file: str) -> np.ndarray:
    head = files.read(file, 0, len(MAGIC) + 8)
    if head[: len(MAGIC)] != MAGIC:
        raise ValueError(f"{file} is no token file")
    _, packed = struct.unpack_from("<II", head, len(MAGIC))
    return np.frombuffer(zlib.decompress(files.read(file, len(head), packed)), np.uint8)


@lru_cache(maxsize=4)
def _code(packed: bytes) -> Code:
    return Code.of(np.frombuffer(packed, np.uint8))


@lru_cache(maxsize=4096)
def _code_of(file: str) -> Code:
    """The code of a file; its header is read once by a Python worker, and files of one writing share one table."""
    return _code(read_lengths(file).tobytes())


def read_files(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of all documents, from the files."""
    totals = manifest.groupBy("part", "file").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    bases = dict(zip((t.file for t in totals), accumulate((t.n for t in totals), initial=0)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                code = _code_of(row["file"])
                docs, ids = read_block(files.read(row["file"], row["offset"], row["length"]), code)
                sizes = np.array([len(x) for x in ids], np.int64)
                starts = bases[row["file"]] + row["first"] + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(starts), pa.array(sizes), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    # The manifest is small and the blocks are not: the number of tasks must not follow the manifest's bytes.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = manifest.select("file", "block", "offset", "length", "first")
    return blocks.repartition(tasks, "file", "block").mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary")


def token_files(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, folder: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """Encode, write and describe: the manifest of the files in ``folder`` (a fresh shared one if not given).

    ``tokenizer`` drops white space and never looks across it. Null and empty texts are the end id alone.
    Documents without an id come first; of equal ids the order is that of their ids' checksum. Other columns
    are not read. Without documents there are no files.
    """
    vocabulary = max(load_tokenizer(tokenizer).get_vocab_size(), end_id + 1)
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    tokens = materialise(tokenised(docs, id_col, text_col, tokenizer, end_id, dtype), "tokens")
    lengths = code_lengths(id_counts(tokens, dtype, vocabulary), limit)
    folder = files.make_folder(folder or fresh_path(docs.sparkSession, "token-files"))
    return write_files(tokens, lengths, folder, dtype)


@query
def op5_token_files(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    back = read_files(token_files(table(spark, sf_dir, "documents"), "doc_id", "text", path, end_id=1))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
