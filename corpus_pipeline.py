"""A corpus pipeline: good documents in a known language, one of each group, free of benchmark passages, as tokens.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and its result is written
as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dimflow.llm import bpe, decontaminate, langid, neardup, quality
from dimflow.llm.common import prepare, table
from dimflow.session import materialise

#: Fitted language classifiers have no SQL form.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that no quality rule rejects; null and empty texts have no words and are rejected."""
    prepare(spark)
    return quality.good(docs)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose language is told clearly; texts without letters and ambiguous ones go, an empty table stays empty."""
    prepare(spark)
    return langid.recognised(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, 80 per cent; the document with the least id stays, and of repeated rows one."""
    prepare(spark)
    return neardup.one_of_each(docs, "doc_id", "text", size=5, percent=80)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in which no window of a benchmark item occurs; null texts hold none."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each text's token ids and of the bytes they decode to; a null text has none."""
    prepare(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))  # beside the codecs there is less room
    return bpe.round_trip(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=False)


STAGES = [
    ("quality_rules", good_quality),
    ("language_id", known_language),
    ("near_dedup", one_of_each),
    ("decontamination", no_benchmark),
    ("bpe", as_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each but the last is written to the shared folder and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
