"""Spelling variants: words one edit apart, and for each word the commoner word it is likely a form of.

Two words one edit apart share the first or the last half of either. So the vocabulary is sorted twice, as it is
and with its words reversed, and each sorted list is cut into blocks of even size. A word is looked up in the
blocks that its first half's range reaches into, mostly one. There a scan walks the sorted words of that range with
one row of the edit matrix for each depth, three cells wide: rows of the prefix that a word shares with the one
before are kept, and once all cells of a row exceed one edit every word with that prefix is skipped.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import query, slices, table, text_buffer
from dimflow.session import materialise

LEAST_LENGTH, LEAST_COUNT, SPOILT_OF = 5, 3, 97
BLOCK_WORDS = 50_000
OUTPUT_ROWS = 20_000


def after(prefix: str) -> str | None:
    """The least text above all texts with this prefix; None if there is none."""
    while prefix:
        if ord(prefix[-1]) < 0x10FFFF:
            return prefix[:-1] + chr(ord(prefix[-1]) + 1)
        prefix = prefix[:-1]
    return None


class SortedWords:
    """Sorted distinct words, and how much of it each shares with the one before."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.shared = [0, *(len(commonprefix(pair)) for pair in zip(words, words[1:]))]

    def one_edit(self, word: str, prefix: int) -> list[int]:
        """Places of the words one edit from ``word`` that share its first ``prefix`` characters."""
        words, shared, length = self.words, self.shared, len(word)
        at, stop = bisect_left(words, word[:prefix]), after(word[:prefix])
        end = len(words) if stop is None else bisect_left(words, stop, at)
        # Cells of depth d: edits from its d characters to the d - 1, d and d + 1 first of ``word``; 2 is too many.
        rows = [(2, 2, 2)] * prefix + [(1 if prefix else 2, 0, 1 if length > prefix else 2)] + [(2, 2, 2)] * (length + 2)
        padded, known, found = word + "\0\0", prefix, []
        while at < end:
            other = words[at]
            left, middle, right = rows[known]
            depth = known
            for depth in range(known + 1, min(len(other), length + 2) + 1):
                letter = other[depth - 1]
                a = left + (depth < 2 or letter != padded[depth - 2])
                if middle < a:
                    a = middle + 1
                b = middle + (letter != padded[depth - 1]) if depth <= length else 2
                if depth <= length:
                    b = min(b, right + 1, a + 1)
                c = min(right + (letter != padded[depth]), b + 1) if depth < length else 2
                left, middle, right = rows[depth] = (a, b, c)
                if a > 1 and b > 1 and c > 1:
                    break
            else:
                depth = len(other)
                if abs(depth - length) < 2 and (left, middle, right)[length - depth + 1] == 1:
                    found.append(at)
                at += 1
                known = min(depth, shared[at]) if at < end else 0
                continue
            beyond = after(other[:depth])
            at = end if beyond is None else bisect_left(words, beyond, at, end)
            known = min(depth, shared[at]) if at < end else 0
        return found


def word_counts(docs: DataFrame, id_col: str, text_col: str, spoilt_of: int = SPOILT_OF, least: int = LEAST_LENGTH) -> DataFrame:
    """``word`` and ``n``: words of ``least`` code points or more and how often they occur in all texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. Where ``spoilt_of`` divides the crc32 h of
    "<id>:<word>" the word counts without its code point h modulo its length; 0 spoils none. A null id is written
    as nothing, null texts have no words, and each row counts for itself. Counts are made in each batch and
    again before the shuffle, so a word of any frequency moves as one row for each task.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall

    def words_of(name: str, text: bytes) -> list[str]:
        words = runs(text.lower().decode())
        begin, bad = zlib.crc32(f"{name}:".encode()), {}
        if spoilt_of:
            for word in set(words):
                h = zlib.crc32(word.encode(), begin)
                if h % spoilt_of == 0:
                    bad[word] = word[: h % len(word)] + word[h % len(word) + 1 :]
        return [bad.get(w, w) for w in words] if bad else words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffer(batch.column(1))
            names = batch.column(0).to_pylist()
            for a, b in slices(np.diff(bounds), 8 << 20):
                total = Counter()
                for i in range(a, b):
                    total.update(words_of(names[i] or "", data[bounds[i] : bounds[i + 1]].tobytes()))
                kept = {w: n for w, n in total.items() if len(w) >= least}
                yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def one_edit_pairs(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word``, ``near``, ``near_n``: each word with every word exactly one edit away, in both directions.

    ``words`` has distinct ``word`` and their ``n``. One row for each block of the sorted lists reaches the driver.
    """
    keys = words.select(
        "n", F.explode(F.array(F.struct(F.lit(False).alias("back"), F.col("word").alias("key")),
                               F.struct(F.lit(True).alias("back"), F.reverse("word").alias("key")))).alias("k"),
    ).select("k.back", "k.key", "n")
    blocks = max(1, -(-2 * words.count() // block_words))
    listed = keys.repartitionByRange(blocks, "back", "key").withColumn("block", F.spark_partition_id())
    listed = materialise(listed, "sorted-words")
    spans = listed.groupBy("block").agg(F.min(F.struct("back", "key")).alias("first"), F.max(F.struct("back", "key")).alias("last"))
    spans = sorted((tuple(s.first), tuple(s.last), s.block) for s in spans.collect())
    firsts, lasts, numbers = ([s[i] for s in spans] for i in range(3))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each word as a question to every block that may hold words with its first half."""
        for batch in batches:
            back, asked, to = [], [], []
            for side, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                half = key[: len(key) // 2]
                stop = after(half)
                end = bisect_left(firsts, (side, stop)) if stop is not None else bisect_left(firsts, (side + 1, ""))
                for i in range(bisect_left(lasts, (side, half)), end):
                    back.append(side)
                    asked.append(key)
                    to.append(numbers[i])
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(back, pa.bool_()), pa.array(asked, pa.string())], names=["block", "back", "key"])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block the sorted words come first and stay, then the questions pass."""
        held, block, counts, side, index = [], None, [], None, None
        left, right, n = [], [], []

        def answers() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"])
            for column in (left, right, n):
                column.clear()
            return out

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for at, ask, back, key, times in zip(*columns):
                if at != block:
                    held, block, counts, index, side = [], at, [], None, None
                if not ask:
                    held.append((back, key))
                    counts.append(times)
                    continue
                if back != side:  # a block may hold the end of one list and the beginning of the other
                    side = back
                    low, high = bisect_left(held, (back, "")), bisect_left(held, (back + 1, ""))
                    index = SortedWords([k for _, k in held[low:high]])
                half = len(key) // 2
                for i in index.one_edit(key, half):
                    other = index.words[i]
                    if back:
                        if key[::-1][:half] == other[::-1][:half]:
                            continue  # found in the other list
                        other = other[::-1]
                    left.append(key[::-1] if back else key)
                    right.append(other)
                    n.append(counts[low + i])
                if len(left) >= OUTPUT_ROWS:
                    yield answers()
        yield answers()

    questions = listed.select("back", "key").mapInArrow(routed, "block int, back boolean, key string")
    both = listed.select("block", F.lit(False).alias("ask"), "back", "key", "n").unionAll(
        questions.select("block", F.lit(True), "back", "key", F.lit(None).cast("long"))
    )
    order = ["block", "ask", "back", "key"]
    return both.repartition(blocks, "block").sortWithinPartitions(*order).mapInArrow(scanned, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of rows ``word``, ``form``: forms followed to the last, by doubling the steps each round.

    Forms lead to no word twice, as each is commoner than the one before, at least twice; so a chain has no more
    than 63 steps and the rounds are at most seven.
    """
    ups = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        above = ups.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        further = materialise(ups.join(above, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved")), "roots")
        ups = further.select("word", "root")
        if further.where("_moved").isEmpty():
            return ups


def variants(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` for each word of a vocabulary.

    ``words`` has a row ``word``, ``n`` for each word; other columns are not read and null words are left out. ``n_near`` counts
    the words exactly one edit away (a code point put in, left out or replaced). ``form`` is the commonest of these,
    the least in code-point order of equals, if it occurs at least twice as often as the word, else null; ``root``
    is where forms lead in the end, the word itself if it has none. An empty vocabulary gives no rows.
    """
    words = materialise(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("_minus"), F.col("near").alias("form"))).alias("_best")
    near = one_edit_pairs(words, block_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    commoner = -F.col("_best._minus") >= 2 * F.col("n")
    known = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(commoner, F.col("_best.form")).alias("form"), F.when(commoner, -F.col("_best._minus")).alias("form_n"),
    ), "near-words")
    last = roots(known.where("form is not null"))
    return known.join(last, "word", "left").select(*known.columns, F.coalesce("root", "word").alias("root"))


@query
def op12_spelling_variants(spark, sf_dir):
    counts = word_counts(table(spark, sf_dir, "documents"), "doc_id", "text")
    return variants(counts.where(F.col("n") >= LEAST_COUNT))
