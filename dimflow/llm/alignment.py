"""Where two tokenizers cut the same bytes, and which tokens of the one stand for which of the other.

Token lists of a batch are flattened with their parents' numbers, and cumulative sums of token lengths within each
document give the bytes at which tokens end. An Acero hash join on keys of document and end leaves the ends both have; they
cut the documents into groups. Within a group every token of the first is linked with every token of the second. Small
groups' links are laid out; those of large ones are counted, not listed: a group's distinct ids of either side are
joined on the group, with the product of how often they are there.

Counts over all documents: each task counts its distinct (document, pair) rows by ``Table.group_by`` in blocks of
bounded text, Spark adds the blocks' counts up, and each block gets back the counts of the pairs it holds. So what a
task holds depends on a block's text, and no table of all pairs is sent anywhere.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import batched, chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import query, slices, table, text_buffer
from dimflow.llm.pieces import uneven_blanks
from dimflow.llm.token_counts import load_tokenizer
from dimflow.session import materialise

SLICE_BYTES = 1 << 19
BLOCK_BYTES = 64 << 20  # of text; a longer text is a block of its own
MERGE_EVERY = 8
MOST_PIECES = 400_000  # a worker remembers
LARGE_GROUP = 64  # links
LINE = 512  # words that go to the libraries in one text
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_AS_IS = b"\xff"  # in no text: begins the key of a piece that has no blank before it
#: A document has ``links``; a block's last row has ``pairs`` and, for each, the number of ``documents`` that hold it.
_ROWS = ("id {id}, block long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, "
         "pairs array<long>, documents array<long>")  # fmt: skip
_DOC = "struct<id:{id},n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups:string,links:binary>"


def byte_level() -> dict[str, int]:
    """The bytes that the characters of byte-level tokens stand for: printable ones for themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, their tokens' bytes, and the ids of pieces already met, up to a number of them.

    A text has a blank put before it and is cut before each blank or line break that follows no white space: no token of
    either reaches over that place. A piece is kept with its ids under both, and whether both give its bytes back, by its
    bytes without the blank it begins with.
    """

    def __init__(self, first: str, second: str) -> None:
        import sentencepiece

        one = load_tokenizer(first)
        one.encode_special_tokens = True
        two = sentencepiece.SentencePieceProcessor(model_file=second)
        as_byte = byte_level()
        self.size = two.get_piece_size()
        ids = range(one.get_vocab_size())
        words = [one.id_to_token(i) or "" for i in ids]
        self.bytes_a = [bytes(map(as_byte.__getitem__, w)) if all(c in as_byte for c in w) else w.encode() for w in words]
        pieces = [two.id_to_piece(i) for i in range(self.size)]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("tokens of the second tokenizer reach over blanks or line breaks")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))

        self.one, self.two, self.blank = one, two, two.piece_to_id("▁")
        self._restart()

    def _restart(self) -> None:
        #: The number of a piece; for either side the ids of all pieces and how many each has; whether both give it back.
        self.number: dict[bytes, int] = {}
        self.flat: tuple[list[np.ndarray], ...] = ([], [])
        self.sizes: tuple[list[np.ndarray], ...] = ([], [])
        self.good: list[np.ndarray] = []

    def _learn(self, keys: list[bytes]) -> None:
        """Words go to the libraries many in a line, whose tokens are cut where the words end; other pieces one by one."""
        words = [k for k in keys if k[:1] != _AS_IS and _is_word(k)]
        after = [k for k in keys if k[:2] == _AS_IS + b"\n" and _is_word(k[2:])]
        lines = [line for line in batched(words + after, LINE) if line[0][:1] != _AS_IS]
        texts = [b"".join(map(_whole, line)) for line in lines]
        found = self._encode(texts, [t[1:] for t in texts])
        done = set()
        for line, text, ids_a, ids_b in zip(lines, texts, *found):
            ends, parts = np.cumsum([len(_whole(k)) for k in line]), []
            for ids, as_bytes, lengths in ((ids_a, self.bytes_a, self.lengths_a), (ids_b, self.bytes_b, self.lengths_b)):
                ids = np.array(ids, np.int64)
                reached = np.cumsum(lengths[ids])
                last = np.searchsorted(reached, ends)
                whole = b"".join(map(as_bytes.__getitem__, ids.tolist())) == text
                parts.append((ids, np.diff(last, prepend=-1)) if whole and (reached[last] == ends).all() else None)
            if None not in parts:
                self._add(line, parts, np.ones(len(line), bool))
                done.update(line)
        keys = [k for k in keys if k not in done]
        # The second puts a blank before what it gets: that is the piece's own, or it is taken off.
        whole = [_whole(k) for k in keys]
        first, second = self._encode(whole, [k.removeprefix(_AS_IS) for k in keys])
        second = [i[1:] if k[:1] == _AS_IS else i if k else [self.blank] for i, k in zip(second, keys)]
        good, parts = np.ones(len(keys), bool), []
        for ids, as_bytes in ((first, self.bytes_a), (second, self.bytes_b)):
            good &= np.array([b"".join(map(as_bytes.__getitem__, i)) == w for i, w in zip(ids, whole)], bool)
            parts.append((np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))))
        self._add(keys, parts, good)

    def _encode(self, first: list[bytes], second: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        found = self.one.encode_batch_fast([t.decode() for t in first], add_special_tokens=False)
        return [e.ids for e in found], self.two.encode([t.decode() for t in second], num_threads=1)

    def _add(self, keys: Sequence[bytes], parts: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> None:
        self.number.update(zip(keys, range(len(self.number), len(self.number) + len(keys))))
        self.good.append(good)
        for side, (ids, sizes) in enumerate(parts):
            self.flat[side].append(ids)
            self.sizes[side].append(sizes)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> list[pa.LargeListArray]:
        """Token lists of each text under both; none where either does not give its bytes back, or it has no bytes."""
        cut = list(_pieces(data, bounds))
        pieces = list(chain.from_iterable(cut))
        if len(self.number) > MOST_PIECES:
            self._restart()
        numbers = np.array(list(map(self.number.get, pieces, repeat(-1))), np.int64)
        fresh = np.flatnonzero(numbers < 0).tolist()
        if fresh:
            self._learn(list({pieces[i] for i in fresh}))
            numbers[fresh] = [self.number[pieces[i]] for i in fresh]
            for held in (*self.flat, *self.sizes, self.good):
                held[:] = [np.concatenate(held)]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        doc = np.repeat(np.arange(len(cut)), sizes)
        right = (np.bincount(doc, ~self.good[0][numbers], len(cut)) == 0)[doc] if pieces else np.empty(0, bool)
        numbers, doc = numbers[right], doc[right]
        lists = []
        for flat, sizes in zip(self.flat, self.sizes):
            if not pieces:
                lists.append(pa.LargeListArray.from_arrays(pa.array(np.zeros(len(cut) + 1, np.int64)), pa.array(numbers)))
                continue
            n = sizes[0][numbers]
            ends = np.cumsum(n)
            ids = flat[0][np.repeat((np.cumsum(sizes[0]) - sizes[0])[numbers] - (ends - n), n) + np.arange(n.sum())]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, n, len(cut)).astype(np.int64))])
            lists.append(pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(ids)))
        return lists


def _whole(key: bytes) -> bytes:
    """The bytes of the piece with this key."""
    return key[1:] if key[:1] == _AS_IS else b" " + key


def _is_word(piece: bytes) -> bool:
    text = piece.decode()
    return text.split() == [text]


def _pieces(data: np.ndarray, bounds: np.ndarray) -> Iterator[list[bytes]]:
    """The keys of each text's pieces; none for an empty text."""
    part = data[bounds[0] : bounds[-1]]
    odd = np.sort(np.append(uneven_blanks(part), uneven_blanks(part, 10))) + bounds[0]
    counts = np.searchsorted(odd, bounds)
    for i in range(len(bounds) - 1):
        text = data[bounds[i] : bounds[i + 1]].tobytes()
        if not text:
            yield []
        elif counts[i + 1] > counts[i] or text[:1].isspace() or text[0] >= 128:
            yield [p[1:].encode() if p[0] == " " else _AS_IS + p.encode() for p in _CUT.split(" " + text.decode())]
        else:
            yield text.replace(b"\n", b" \xff\n").split(b" ")


def ends_of(lists: pa.LargeListArray, lengths: np.ndarray) -> pa.Table:
    """The flattened tokens: ``doc`` (the parent's number), ``id`` and ``end``, the byte after the token in its document."""
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pc.take(pa.array(lengths), ids)).to_numpy(zero_copy_only=False)
    begins = lists.offsets.to_numpy()[:-1]
    before = np.concatenate([[0], total])[begins]  # segmented: the sum at each document's first token is taken off
    return pa.table({"doc": parents, "id": ids, "end": total - before[parents.to_numpy(zero_copy_only=False)]})


def groups_of(a: pa.Table, b: pa.Table) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """Both sides with their ``group``, and the document of each group; groups are numbered in order over all documents."""
    wide = int(max(pc.max(a["end"]).as_py() or 0, pc.max(b["end"]).as_py() or 0)) + 1
    keys = [pa.table({"doc_end": pc.add(pc.multiply(side["doc"], wide), side["end"])}) for side in (a, b)]
    common = keys[0].join(keys[1], "doc_end", join_type="inner", use_threads=False)
    cuts = np.sort(common["doc_end"].to_numpy())
    sides = []
    for side, key in zip((a, b), keys):
        last = np.searchsorted(key["doc_end"].to_numpy(), cuts)  # the last token of each group
        sides.append(side.append_column("group", pa.array(np.repeat(np.arange(len(cuts)), np.diff(last, prepend=-1)))))
    return *sides, cuts // wide


def links_of(a: pa.Table, b: pa.Table, docs: np.ndarray, size: int) -> pa.Table:
    """``doc``, ``pair`` and ``times``: how often a pair (first id times ``size`` plus second) is linked in each document."""
    (group_a, id_a), (group_b, id_b) = ([side[c].to_numpy() for c in ("group", "id")] for side in (a, b))
    n_a, n_b = (np.bincount(group, minlength=len(docs)) for group in (group_a, group_b))
    small = n_a * n_b <= LARGE_GROUP
    # Each token of the first side beside all tokens of the second in its group.
    own = np.flatnonzero(small[group_a])
    n = n_b[group_a[own]]
    first = np.repeat(own, n)
    second = np.arange(len(first)) + np.repeat((np.cumsum(n_b) - n_b)[group_a[own]] - (np.cumsum(n) - n), n)
    doc, pair, times = docs[group_a[first]], id_a[first] * size + id_b[second], np.ones(len(first), np.int64)
    if not small.all():
        large = [side.filter(pa.array(~small[group])).select(["group", "id"]) for side, group in ((a, group_a), (b, group_b))]
        large = [side.group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")]) for side in large]
        both = large[0].rename_columns(["group", "a", "n_a"]).join(large[1].rename_columns(["group", "b", "n_b"]), "group", join_type="inner", use_threads=False)
        doc = np.append(doc, docs[both["group"].to_numpy()])
        pair = np.append(pair, both["a"].to_numpy() * size + both["b"].to_numpy())
        times = np.append(times, both["n_a"].to_numpy() * both["n_b"].to_numpy())
    order = np.lexsort((pair, doc))
    doc, pair, times = doc[order], pair[order], times[order]
    new = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(pair) != 0))[: len(doc)])
    return pa.table({"doc": doc[new], "pair": pair[new], "times": np.add.reduceat(times, new) if len(new) else times})


@lru_cache(maxsize=2)
def _decimals(size: int) -> np.ndarray:
    return np.array([str(i) for i in range(size)], object)


def group_texts(a: pa.Table, b: pa.Table, docs: np.ndarray, n_docs: int) -> list[str]:
    """Each document's groups as text: ``a1,a2|b1;a3|b2``."""
    group_a, group_b = a["group"].to_numpy(), b["group"].to_numpy()
    total = len(group_a) + len(group_b)
    # A token's place among all: those of its side before it, and the other side's of earlier groups (the first side's own included).
    at_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a, "left")
    at_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")
    parts = np.empty((total, 2), object)
    for at, side, group, last in ((at_a, a, group_a, "|"), (at_b, b, group_b, ";")):
        ids = side["id"].to_numpy()
        parts[at, 0] = _decimals(int(ids.max(initial=0)) + 1 + (1 << 16) & ~0xFFFF)[ids]
        parts[at, 1] = np.where(np.append(np.diff(group) != 0, True), last, ",").astype(object)[: len(group)]
    ends = np.searchsorted(a["doc"].to_numpy(), np.arange(n_docs), "right") + np.searchsorted(b["doc"].to_numpy(), np.arange(n_docs), "right")
    flat, starts = parts.reshape(-1), np.concatenate([[0], ends[:-1]])
    return ["".join(flat[2 * s : 2 * e - 1].tolist()) if e > s else "" for s, e in zip(starts.tolist(), ends.tolist())]


@lru_cache(maxsize=1)
def pair_of(first: str, second: str) -> Pair:
    """One for all tasks of a Python worker, so that pieces met in one task are known in the next."""
    return Pair(first, second)


def _packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pairs as differences, and their times, compressed."""
    return zstandard.compress(np.stack([np.diff(pairs, prepend=0), times]).astype("<i8").T.tobytes(order="F"), 1)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, times = np.frombuffer(zstandard.decompress(raw), "<i8").reshape(2, -1)
    return np.cumsum(steps), times


def _work(first: str, second: str, names: list[str], digest: bool, block_bytes: int = BLOCK_BYTES):
    """Rows of documents, and after each block a row of its pairs and in how many documents each is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, kind, longs = pair_of(first, second), None, pa.list_(pa.int64())
        block, held, seen = TaskContext.get().partitionId() << 32, 0, []

        def merged() -> pa.Table:
            return pa.concat_tables(seen).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        def closed() -> pa.RecordBatch:
            total = merged()
            counts = (pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), total[c].combine_chunks()) for c in ("pair", "n"))
            columns = [pa.nulls(1, kind), pa.array([block], pa.int64()), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), *counts]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            kind = batch.column(0).type
            data, bounds = text_buffer(batch.column(1))
            for lo, hi in slices(np.diff(bounds), SLICE_BYTES):
                n_docs = hi - lo
                lists = pair(data, bounds[lo : hi + 1])
                a, b = (ends_of(side, n) for side, n in zip(lists, (pair.lengths_a, pair.lengths_b)))
                a, b, of_group = groups_of(a, b)
                links = links_of(a, b, of_group, pair.size)
                pairs, times = links["pair"].to_numpy(), links["times"].to_numpy()
                at = np.searchsorted(links["doc"].to_numpy(), np.arange(n_docs + 1))
                texts = group_texts(a, b, of_group, n_docs)
                if digest:
                    texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
                columns = [
                    batch.column(0).slice(lo, n_docs), pa.array(np.full(n_docs, block)),
                    *(pa.array(np.diff(side.offsets.to_numpy())) for side in lists), pa.array(np.bincount(of_group, minlength=n_docs)),
                    pa.array([int(times[x:y].sum()) for x, y in pairwise(at.tolist())]), pa.array(texts, pa.string()),
                    pa.array([_packed(pairs[x:y], times[x:y]) for x, y in pairwise(at.tolist())], pa.binary()),
                    *[pa.nulls(n_docs, longs)] * 2,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                seen.append(links.select(["pair"]).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"]))
                if len(seen) >= MERGE_EVERY:
                    seen = [merged()]
                held += int(bounds[hi] - bounds[lo])
                pa.default_memory_pool().release_unused()
                if held >= block_bytes:
                    yield closed()
                    block, held, seen = block + 1, 0, []
        if seen:
            yield closed()

    return work


def _aligned(docs: DataFrame, id_col: str, text_col: str, first: str, second: str, digest: bool, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType.fromDDL(_ROWS.format(id=rows.schema["id"].dataType.simpleString()))
    return rows.mapInArrow(_work(first, second, schema.names, digest, block_bytes), schema)


def groups(docs: DataFrame, id_col: str, text_col: str, first: str, second: str) -> DataFrame:
    """``id_col``, ``n_a``, ``n_b``, ``n_groups`` and ``groups`` (``a1,a2|b1;a3|b2``) for each document.

    ``first`` is the path of a byte-level BPE file, ``second`` of a sentencepiece model that puts a blank before texts.
    Nothing is shuffled. Cases are as in :func:`alignment`.
    """
    found = _aligned(docs, id_col, text_col, first, second, digest=False).where("pairs is null")
    return found.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "groups")


def alignment(
    docs: DataFrame, id_col: str, text_col: str, first: str, second: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` for each document.

    The counts are as in :func:`pair_counts`, over all rows of ``docs``. Null and empty texts, and texts that either
    tokenizer does not give back byte by byte, have no tokens: zeros and an empty ``groups_sha256``. Each row is a document
    of its own, so repeated rows count each; null ids are kept; other columns are not read. No documents give no rows.
    """
    rows = materialise(_aligned(docs, id_col, text_col, first, second, True, block_bytes), "aligned")
    held = rows.where("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "documents")).alias("p")).select("block", "p.*")
    counts = materialise(_counts(held, second), "pair-counts")
    # One row for each pair of a block: its count, and below zero where another pair of the same first id has more.
    answers = held.select("block", F.col("pairs").alias("pair")).join(counts, "pair").select(
        "block", F.lit(False).alias("is_doc"), "pair", F.when(F.col("best"), F.col("n")).otherwise(-F.col("n")).alias("n"),
        F.lit(None).cast(_DOC.format(id=rows.schema["id"].dataType.simpleString())).alias("doc"),
    )
    doc = F.struct("id", "n_a", "n_b", "n_groups", "n_links", "groups", "links")
    asked = rows.where("pairs is null").select("block", F.lit(True), F.lit(None).cast("long"), F.lit(None).cast("long"), doc)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = answers.unionAll(asked).repartition(tasks, "block").sortWithinPartitions("block", "is_doc")
    schema = T.StructType.fromDDL(f"id {rows.schema['id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
                                  "n_best long, count_sum long, groups_sha256 string")  # fmt: skip

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block the counts come first and stay, then its documents pass."""
        block, parts, pairs, counts = None, [], None, None
        for batch in batches:
            blocks, is_doc = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(is_doc.astype(np.int8)) != 0)) + 1
            for lo, hi in pairwise([0, *edges.tolist(), len(blocks)]):
                part = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, parts, pairs = blocks[lo], [], None
                if not is_doc[lo]:
                    parts.append(np.stack([part.column(i).to_numpy() for i in (2, 3)]))
                    continue
                if pairs is None:
                    pairs, counts = np.concatenate(parts, 1) if parts else np.empty((2, 0), np.int64)
                    order = np.argsort(pairs)
                    pairs, counts, parts = pairs[order], counts[order], []
                docs = part.column(4)
                best, total = [], []
                for raw in docs.field("links"):
                    own, times = _unpacked(raw.as_py())
                    n = counts[np.searchsorted(pairs, own)]
                    best.append(int(times[n > 0].sum()))
                    total.append(int((times * np.abs(n)).sum()))
                fields = [docs.field(k) for k in ("id", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([*fields, pa.array(best, pa.int64()), pa.array(total, pa.int64()), docs.field("groups")], names=schema.names)

    return both.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def _counts(held: DataFrame, second: str) -> DataFrame:
    """``pair``, ``n`` and whether no pair of the same first id has more; the greatest count of each first id is one row per id."""
    size = pair_size(second)
    counts = materialise(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("documents").alias("n")), "pair-sums")
    a = F.expr(f"pair div {size}").alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def pair_size(second: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=second).get_piece_size()


def pair_counts(docs: DataFrame, id_col: str, text_col: str, first: str, second: str) -> DataFrame:
    """``a``, ``b``, ``n`` and ``best``: linked ids, in how many documents they are, and whether that is the most for ``a``."""
    rows = _aligned(docs, id_col, text_col, first, second, digest=True).where("pairs is not null")
    held = rows.select(F.explode(F.arrays_zip("pairs", "documents")).alias("p")).select("p.*")
    size = pair_size(second)
    return _counts(held, second).select(F.expr(f"pair div {size}").alias("a"), F.expr(f"pair % {size}").alias("b"), "n", "best")


@query
def op11_alignment(spark, sf_dir):
    import public_tokenizers

    first, second = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment(table(spark, sf_dir, "documents"), "doc_id", "text", first, second)
