"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Encoding. BPE's result is known from neighbours alone: a sequence of tokens is the result for its bytes
if and only if each token is what its own bytes give, and each two neighbours are what the bytes of the two
give. So a nondeterministic transducer reads bytes along a trie of the tokens; at a token's end it may
close the token if it fits its predecessor. A deterministic state is the set of readings still possible, each with
the tokens not yet emitted; what all readings agree on is emitted at once, so a state holds only as much as the
longest token can still change. States and their transitions are made when first reached and kept up to
a bound.

Decoding. Ids become bytes by a table; a UTF-8 state machine runs over the end of each chunk and holds
back a character that is not complete, so text comes out in whole characters however ids are cut.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import give_back, query, slices, table, text_buffer
from dimflow.llm.pieces import Memo, spaced_pieces

_MOST_STATES, _MOST_BYTES = 300_000, 24 << 20  # of a codec that is kept
_FEW_STATES, _FEW_BYTES = 60_000, 4 << 20  # of one that has little memory
_DECODE_IDS = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file: base64 and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int], halves: bool = False) -> list[bytes]:
    """BPE by its definition: join the neighbours of the lowest rank, the first of equals, until none is left.

    With ``halves`` it stops before the merge that would leave one part.
    """
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1 + halves:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Ids of a piece, see the module's description."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = _MOST_STATES) -> None:
        self.ranks, self.most_states = ranks, most_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.inner: list[bool] = [False]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.inner[node] = True
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.token_at[node] = rank
        self.fits_memo: dict[int, bool] = {}
        self.halves_memo: dict[int, tuple[int, int] | None] = {}
        self._restart()

    def _restart(self) -> None:
        #: A state is a tuple of readings (last closed token, tokens not emitted, place in the trie).
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.ending: list[tuple[int, ...] | None] = []
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._state(((-1, (), 0),))

    def _state(self, readings: tuple) -> int:
        number = self.number.setdefault(readings, len(self.states))
        if number == len(self.states):
            self.states.append(readings)
            _, pending, node = readings[-1]
            self.ending.append(None if node else pending)
        return number

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte or a token BPE never makes."""
        if token not in self.halves_memo:
            parts = merged(self.bytes_of[token], self.ranks, len(self.bytes_of[token]) > 1)
            whole = len(parts) == 2 and parts[0] + parts[1] == self.bytes_of[token]
            self.halves_memo[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if whole else None
        return self.halves_memo[token]

    def _made(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self._halves(token) is not None

    def _fits(self, last: int, token: int) -> bool:
        """Whether BPE makes ``token`` at all and leaves it as a neighbour of ``last`` (-1: of nothing)."""
        return self._made(token) and (last < 0 or self._made(last) and self._apart(last, token))

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: their merges are undone, the latest first.

        Whatever then stands on the two sides of the border could have been merged; its turn must not
        have come before that of the merge undone.
        """
        bytes_of, rank_of = self.bytes_of, self.ranks.get
        turn = 1 << 60  # merges of a lower rank than this came before what is undone
        while True:
            joint = rank_of(bytes_of[left] + bytes_of[right])
            if joint is not None and joint < turn:
                return False
            parts_left = self._halves(left) if len(bytes_of[left]) > 1 else None
            parts_right = self._halves(right) if len(bytes_of[right]) > 1 else None
            if parts_left is None and parts_right is None:
                return True
            # Of equal ranks the left one is merged first, so the right one is undone first.
            if parts_right is None or parts_left is not None and left > right:
                turn, left = left, parts_left[1]
            else:
                turn, right = right + 1, parts_right[0]

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        child, token_at, inner, memo = self.child, self.token_at, self.inner, self.fits_memo
        after, closed = [], None
        for reading in self.states[state]:
            last, pending, node = reading
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if inner[node]:
                after.append((last, pending, node))
            token = token_at[node]
            if token >= 0 and closed is None:  # bytes have one BPE result, so one reading at most closes here
                key = (last + 1) << 32 | token
                fits = memo.get(key)
                if fits is None:
                    fits = memo[key] = self._fits(last, token)
                if fits:
                    closed = (token, (*pending, token), 0)
        if closed is not None:
            after.append(closed)  # readings stay in the order of where their open token began
        if not after:
            raise ValueError(f"no token begins with byte {byte} here")
        first = after[0][1]
        agreed = len(first)
        if agreed and len(after) > 1:
            agreed = min(agreed, *[len(pending) for _, pending, _ in after])
            while agreed and any(pending[:agreed] != first[:agreed] for _, pending, _ in after):
                agreed -= 1
        if not agreed:
            return self._state(tuple(after)), ()
        return self._state(tuple([(last, pending[agreed:], node) for last, pending, node in after])), first[:agreed]

    def __call__(self, piece: bytes) -> list[int]:
        if len(self.states) > self.most_states:
            self._restart()
        if len(self.fits_memo) > 4 * self.most_states:
            self.fits_memo.clear()
        state, steps, ids = 0, self.steps, []
        for byte in piece:
            key = state << 8 | byte
            step = steps.get(key)
            if step is None:
                step = steps[key] = self._step(state, byte)
            state, emitted = step
            if emitted:
                ids += emitted
        left = self.ending[state]
        if left is None:
            raise ValueError("the tokens cannot spell this piece")
        return ids + list(left)


class Utf8End:
    """How many bytes of a chunk belong to whole characters, by the state after each of its last bytes.

    The state is the number of continuation bytes still due, and the range that the next must lie in.
    Bytes that can't be part of a character count as whole: they are passed on, not held back.
    """

    @staticmethod
    def step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int]:
        due, low, high = state
        if due and low <= byte <= high:
            return due - 1, 0x80, 0xBF
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return 0, 0x80, 0xBF

    @classmethod
    def whole(cls, chunk: bytes) -> int:
        begin = max(0, len(chunk) - 3)
        state, started = (0, 0x80, 0xBF), len(chunk)
        for at in range(begin, len(chunk)):
            followed = state[0] > 0 and state[1] <= chunk[at] <= state[2]
            state = cls.step(state, chunk[at])
            if not followed and state[0]:
                started = at
        return started if state[0] else len(chunk)


class Decoder:
    """Bytes of ids in whole characters, chunk by chunk."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.lookup, self.held = bytes_of.__getitem__, b""

    def feed(self, ids: list[int]) -> bytes:
        chunk = self.held + b"".join(map(self.lookup, ids))
        whole = Utf8End.whole(chunk)
        self.held = chunk[whole:]
        return chunk[:whole]

    def finish(self) -> bytes:
        left, self.held = self.held, b""
        return left


class Codec:
    """Texts to ids and back. The bounds say how much is remembered of earlier texts, never what ids a text has."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_states: int = _MOST_STATES, most_bytes: int = _MOST_BYTES) -> None:
        import regex

        self.split, self.transducer = regex.compile(pattern).findall, Transducer(ranks, most_states)
        self.plain = Memo(lambda keys: map(self._encode, (k.decode() for k in keys)), most_bytes)
        self.spaced = Memo(lambda keys: map(self._encode, (" " + k.decode() for k in keys)), most_bytes)

    def _encode(self, text: str) -> bytes:
        ids = [i for piece in self.split(text) for i in self.transducer(piece.encode())]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        texts = list(spaced_pieces(data, bounds))
        self.plain.learn(p for plain, _ in texts for p in plain)
        self.spaced.learn(p for _, spaced in texts for p in spaced)
        plain, spaced = self.plain.known.__getitem__, self.spaced.known.__getitem__
        for a, b in texts:
            yield b"".join(map(plain, a)) + b"".join(map(spaced, b))

    def decode(self, ids: bytes) -> Iterator[bytes]:
        """The bytes of the ids, in chunks of whole characters."""
        decoder, numbers = Decoder(self.transducer.bytes_of), np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), _DECODE_IDS):
            yield decoder.feed(numbers[at : at + _DECODE_IDS].tolist())
        yield decoder.finish()


@lru_cache(maxsize=2)
def codec(rank_file: str, pattern: str) -> Codec:
    """One for all tasks of a Python worker: states and pieces made in one task are there in the next."""
    return Codec(load_ranks(rank_file), pattern)


def _long(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


def encoded(docs: DataFrame, id_col: str, text_col: str, rank_file: str, pattern: str) -> DataFrame:
    """``id_col`` and ``ids`` (binary, little-endian unsigned 32-bit) for each document; null texts have no ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(rank_file, pattern)
        for batch in batches:
            data, bounds = text_buffer(batch.column(1))
            ids = [x for a, b in slices(np.diff(bounds)) for x in known.encode(data, bounds[a : b + 1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return rows.mapInArrow(work, _long(**{id_col: rows.schema[0].dataType, "ids": T.BinaryType()}))


def decoded(tokens: DataFrame, id_col: str, ids_col: str, rank_file: str) -> DataFrame:
    """``id_col`` and ``text`` of ids as ``encoded`` makes them; bytes that are no UTF-8 become U+FFFD."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {rank: token for token, rank in load_ranks(rank_file).items()}
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                decoder = Decoder(bytes_of)
                numbers = np.frombuffer(ids.as_py() or b"", "<u4").tolist()
                texts.append((decoder.feed(numbers) + decoder.finish()).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    rows = tokens.select(F.col(f"`{id_col}`"), F.col(f"`{ids_col}`"))
    return rows.mapInArrow(work, _long(**{id_col: rows.schema[0].dataType, "text": T.StringType()}))


def round_trip(docs: DataFrame, id_col: str, text_col: str, rank_file: str, pattern: str, keep: bool = True) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: each text encoded and decoded again.

    Null and empty texts have no ids. Each row stands for itself, whatever its id; other columns are not read.
    With ``keep`` a Python worker has its codec ready for later tasks, which costs it 300 MB and more while other stages run.
    Without, each task makes its own, which remembers less, and what earlier tasks freed goes back to the system first.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            give_back()
        known = codec(rank_file, pattern) if keep else Codec(load_ranks(rank_file), pattern, _FEW_STATES, _FEW_BYTES)
        for batch in batches:
            data, bounds = text_buffer(batch.column(1))
            counts, ids_sha, text_sha = [], [], []
            for a, b in slices(np.diff(bounds)):
                for ids in known.encode(data, bounds[a : b + 1]):
                    counts.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    digest = hashlib.sha256()
                    for chunk in known.decode(ids):
                        digest.update(chunk)
                    text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    made = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return rows.mapInArrow(work, _long(**{id_col: rows.schema[0].dataType}, **made))


@query
def op6_bpe_round_trip(spark, sf_dir):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", ranks, public_tokenizers.PATTERN)
