"""Token counts of whole texts: a public tokenizer in Arrow functions that return lengths only."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import query, slices, table, text_buffer
from dimflow.llm.pieces import Memo, spaced_pieces

LIMIT = 512


def load_tokenizer(path: str):
    """The tokenizer of a ``.json`` file, one thread, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Counter:
    """Counts tokens of byte-level BPE texts piece by piece, see ``pieces``."""

    def __init__(self, path: str) -> None:
        tokenizer = load_tokenizer(path)

        def lengths(texts: list[str]) -> list[int]:
            return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        self.plain = Memo(lambda keys: lengths([k.decode() for k in keys]))
        self.spaced = Memo(lambda keys: lengths([" " + k.decode() for k in keys]))

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> list[int]:
        texts = list(spaced_pieces(data, bounds))
        self.plain.learn(p for plain, _ in texts for p in plain)
        self.spaced.learn(p for _, spaced in texts for p in spaced)
        plain, spaced = self.plain.known.__getitem__, self.spaced.known.__getitem__
        return [sum(map(plain, a)) + sum(map(spaced, b)) for a, b in texts]


def token_counts(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for each document.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library. Special strings inside texts
    count as that file has it. Null and empty texts have 0 bytes and tokens. Each row stands for itself, so
    repeated rows and null ids need no care; other columns are not read. Batches are cut by bytes, not rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(tokenizer)
        for batch in batches:
            data, bounds = text_buffer(batch.column(1))
            sizes = np.diff(bounds)
            found = [n for a, b in slices(sizes) for n in count(data, bounds[a : b + 1])]
            tokens = np.array(found, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = T.StructType([
        T.StructField(id_col, rows.schema[0].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])
    return rows.mapInArrow(work, schema)


@query
def op4_token_counts(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", path)
