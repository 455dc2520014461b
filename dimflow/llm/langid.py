"""Language identification by error-correcting output codes over byte n-grams.

Each language has a codeword. For each bit a logistic classifier, fitted on hashed n-gram shares of a bounded
sample of labelled documents, says which side of the bit a text is on. Decoding adds up, for each
codeword, the losses of all bits weighted by how well each bit did on rows kept back, and takes the
nearest codeword. A text whose two nearest codewords are about as near is flagged as ambiguous: the gap of
their losses, unlike a score over all languages, means the same for any number of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import query, slices, table, text_buffer

#: So many distinct labelled texts of each language are learned from, fewer of each if all would be over ``MOST_ROWS``.
ROWS_PER_LANGUAGE = 400
MOST_ROWS = 4000
MOST_LANGUAGES = 500
SALT = 23
FEATURES = 1 << 12
GRAMS = (1, 2, 3)
STEPS, RATE, DECAY = 300, 0.5, 1e-4
#: All but ``FEW`` of the rightly decided rows kept back reach some gap; texts below ``AMBIGUOUS`` of it are ambiguous.
FEW, AMBIGUOUS = 0.01, 0.5
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:65] = 32  # everything in ASCII that is no letter counts as a blank
_FOLD[91:97] = 32
_FOLD[123:128] = 32
_SALTS = np.random.default_rng(11).integers(1, 1 << 31, 3, dtype=np.uint32) | np.uint32(1)


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text the square roots of its hashed n-grams' shares, over the whole text."""
    folded, shift = _FOLD[data[bounds[0] : bounds[-1]]].astype(np.uint32), np.uint32(32 - FEATURES.bit_length() + 1)
    keys, code = [], np.zeros(len(folded), np.uint32)
    for n in GRAMS:
        code = code[: len(folded) - n + 1] * np.uint32(0x01000193) + folded[n - 1 :] + np.uint32(n)
        keys.append(((code * _SALTS[n - 1]) ^ (code * _SALTS[n - 1] >> np.uint32(15))) * np.uint32(0x9E3779B1) >> shift)
    out = np.zeros((len(bounds) - 1, FEATURES), np.float32)
    for i, (a, b) in enumerate(zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0])):
        for n, key in zip(GRAMS, keys):
            if b - a >= n:
                found = np.bincount(key[a : b - n + 1], minlength=FEATURES)
                out[i] += found / (b - a - n + 1)
    return np.sqrt(out)


def codewords(n: int) -> np.ndarray:
    """A codeword of -1 and 1 for each of ``n`` classes, far from one another and with no useless bit."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 5:  # all ways to split the classes in two
        splits = np.arange(1, 1 << (n - 1))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    width = 4 * int(np.ceil(np.log2(n))) + 7
    best, rng = None, np.random.default_rng(5)
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        agree = code @ code.T - 2 * width * np.eye(n)
        useful = (np.abs(code.sum(axis=0)) < n).all()
        if useful and (best is None or agree.max() < best[0]):
            best = (agree.max(), code)
    return best[1]


@dataclass(frozen=True)
class Model:
    """Codewords, a classifier for each bit, each bit's weight, and the gap below which texts are ambiguous."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    limit: float = 0.0

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Each text's weighted mean loss of each codeword."""
        margins = x @ self.weights + self.bias
        each = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        return (each * self.trust).sum(axis=2) / max(self.trust.sum(), 1e-12)


def gaps(losses: np.ndarray) -> np.ndarray:
    """How much farther the second codeword is than the nearest; without a second nothing is ambiguous."""
    if losses.shape[1] < 2:
        return np.full(len(losses), np.inf)
    near = np.partition(losses, 1, axis=1)
    return near[:, 1] - near[:, 0]


def fit(x: np.ndarray, labels: list[str]) -> Model:
    """Fit all bits together by gradient descent; every fifth row of a language is kept back, to weigh them and to set the limit."""
    languages = tuple(sorted(set(labels)))
    y = np.searchsorted(languages, labels) if labels else np.empty(0, int)
    code = codewords(len(languages))
    share = np.bincount(y, minlength=len(languages))
    # Counted within each language, so that none is kept back whole.
    back, together = np.zeros(len(labels), bool), np.argsort(y, kind="stable")
    back[together] = (np.arange(len(labels)) - np.repeat(np.cumsum(share) - share, share)) % 5 == 4
    even = 1 / share[y] / max(len(languages), 1) if len(labels) else np.empty(0)
    w, b = np.zeros((FEATURES, code.shape[1])), np.zeros(code.shape[1])
    speed, x = np.zeros_like(w), x.astype(np.float64)
    train, target, weight = x[~back], code[y[~back]], even[~back, None]
    weight = weight / max(weight.sum(), 1e-12)
    for _ in range(STEPS if code.shape[1] else 0):
        pull = -target / (1 + np.exp(np.clip(target * (train @ w + b), -30, 30))) * weight
        speed = 0.9 * speed - RATE * 10 * (train.T @ pull + DECAY * w)
        w, b = w + speed, b - RATE * pull.sum(axis=0)
    right = (np.sign(x[back] @ w + b) == code[y[back]]).mean(axis=0) if back.any() else np.ones(code.shape[1])
    trust = np.log(np.clip(right, 0.55, 0.999) / (1 - np.clip(right, 0.55, 0.999)))
    model = Model(languages, code, w, b, trust)
    if len(languages) < 2 or not back.any():
        return model
    losses = model.losses(x[back])
    reached = gaps(losses)[losses.argmin(axis=1) == y[back]]
    return replace(model, limit=AMBIGUOUS * float(np.quantile(reached, FEW)) if len(reached) else 0.0)


def held_out(id_col: str) -> Column:
    """Whether a document is kept out of all learning: by the checksum of its id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame | None:
    """``label, text``: of each label the distinct texts with the least salted hashes; None without labels.

    All labels get the same number, ``ROWS_PER_LANGUAGE`` or what keeps them all within ``MOST_ROWS``, or all
    their texts where they have fewer. How often a text comes up and where it stands change nothing.
    """
    text, label = F.col(f"`{text_col}`").cast("string"), F.col(f"`{label_col}`").cast("string")
    usable = docs.where(~held_out(id_col)).select(label.alias("label"), text.alias("text")).where("label IS NOT NULL AND text IS NOT NULL")
    usable = usable.withColumn("hash", F.pmod(F.xxhash64(F.lit(SALT), "text"), F.lit(1 << 62)))
    counts = usable.groupBy("label").agg(F.approx_count_distinct("hash").alias("texts")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels; these are no languages")
    if not counts:
        return None
    each = max(1, min(ROWS_PER_LANGUAGE, MOST_ROWS // len(counts)))
    # Below this hash there are more texts than needed, so that only these move. The bounds are literals.
    below = {r.label: int(min(1.0, (2 * each + 100) / max(r.texts, 1)) * (1 << 62)) for r in counts}
    bounds = F.create_map(*[F.lit(v) for pair in below.items() for v in pair])
    near = usable.where(F.col("hash") < F.element_at(bounds, F.col("label")))
    distinct = near.groupBy("label", "hash").agg(F.min("text").alias("text"))
    least = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    return distinct.withColumn("place", least).where(F.col("place") <= each).select("label", "text")


def train(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> Model:
    """A model of the labelled documents that are not held out, learned from a ``sample`` of each label.

    Only the feature rows of the sample reach the driver.
    """
    chosen = sample(docs, id_col, text_col, label_col)
    if chosen is None:
        return fit(np.empty((0, FEATURES)), [])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffer(batch.column(1))
            rows = [r.tobytes() for a, b in slices(np.diff(bounds)) for r in features(data, bounds[a : b + 1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["label", "x"])

    rows = chosen.mapInArrow(work, "label string, x binary").collect()
    rows.sort(key=lambda r: (bytes(r.x), r.label))
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float32).reshape(len(rows), FEATURES)
    order = np.random.default_rng(1).permutation(len(rows))
    return fit(x[order], [rows[i].label for i in order])


def _judge(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    data, bounds = text_buffer(texts)
    names, scores, unclear = [], [], []
    for a, b in slices(np.diff(bounds)):
        losses = model.losses(features(data, bounds[a : b + 1]))
        near = gaps(losses) < model.limit
        for i, row in enumerate(losses):
            if not len(row) or not _LETTER.search(data[bounds[a + i] : bounds[a + i + 1]].tobytes().decode()):
                names.append(UNKNOWN)
                scores.append(0.0)
                unclear.append(True)
                continue
            best = int(np.argmin(row))
            share = np.exp(row[best] - row)
            names.append(model.languages[best])
            scores.append(float(1 / share.sum()))
            unclear.append(bool(near[i]))
    return names, np.array(scores), np.array(unclear, bool)


def predicted(docs: DataFrame, id_col: str, text_col: str, model: Model) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` for each document.

    Null texts and texts without a letter are ``und`` with score 0 and ambiguous, and so is everything under a
    model that has seen no label. Each row stands for itself; nothing but the text is looked at.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, unclear = _judge(model, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unclear, pa.bool_())],
                names=[id_col, "held_out", "lang_pred", "score", "ambiguous"],
            )

    rows = docs.select(F.col(f"`{id_col}`"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields[:2]]
    made = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType())]
    return rows.mapInArrow(work, T.StructType(fields + [T.StructField(n, t) for n, t in made]))


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a language and is not ambiguous.

    Of one learnt language alone no text is ambiguous: there is nothing to tell it from.
    """
    model, at, schema = train(docs, id_col, text_col, label_col), docs.columns.index(text_col), docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, unclear = _judge(model, batch.column(at))
            yield batch.filter(pa.array(~unclear, pa.bool_()))

    return docs.mapInArrow(work, schema)


@query
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, "doc_id", "text", train(docs, "doc_id", "text", "lang"))
