"""Alignment of two tokenizers against the libraries run on whole texts and groups found byte by byte."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from __spark_entry__ import queries
from dimflow.llm import alignment
from dimflow.llm.common import prepare, table

FIRST, SECOND = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, n_a string, block long, links string"


@pytest.fixture(scope="module")
def libraries():
    one = Tokenizer.from_file(FIRST)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def brute(libraries, texts):
    one, two = libraries
    back = {c: bytes([b]) for c, b in alignment.byte_level().items()}
    out, seen = [], Counter()
    for text in texts:
        groups = []
        if text:
            a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            raw_a = [b"".join(back[c] for c in one.id_to_token(i)) for i in a]
            raw_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                at_a = at_b = i = j = 0
                while i < len(a):
                    own = ([], [])
                    while not own[0] or at_a != at_b:
                        if at_a <= at_b:
                            own[0].append(a[i])
                            at_a += len(raw_a[i])
                            i += 1
                        else:
                            own[1].append(b[j])
                            at_b += len(raw_b[j])
                            j += 1
                    groups.append(own)
        links = Counter((x, y) for own in groups for x in own[0] for y in own[1])
        seen.update(links.keys())
        out.append((groups, links))
    most = defaultdict(int)
    for (x, _), n in seen.items():
        most[x] = max(most[x], n)
    rows = []
    for groups, links in out:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(k for p, k in links.items() if seen[p] == most[p[0]]), sum(k * seen[p] for p, k in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if written else "", written,
        ))
    return rows, seen


def texts() -> list[str | None]:
    rnd = random.Random(2)
    parts = ["the", "Thousands", "über", "日本語", "テキスト", "naïve", "it's", "don't", "x=1;", "\n", "\t", "\r\n", " ", "  ", "   ", "é", "　", "\xa0", "😀", "1234567", "\x1c",
             "<|endoftext|>", "<s>", "<0x41>", "</s>", "́", ";\r", "ﬁ", "\x85", "a" * 30, "…", "—"]
    odd = [None, "", " ", "  ", "   a", "a ", "a  ", "\n", "\n a", "a\n  b", "a \n b", "a ▁b", "▁", "\x00", "a\x00b", "﻿a b", "  b", "é b", " é", "　 a", "�"]
    some = ["".join(rnd.choice(parts) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    words = [" ".join(rnd.choice(["the", "quick", "Foxes", "jumping,", "überall", "and"]) for _ in range(80)) for _ in range(60)]
    return [*odd, *some, *words, words[0], words[0], "ab" * 3000, " " * 500, "word " * 20_000]


def rows_of(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [64 << 20, 2000])
def test_equals_the_libraries(spark, libraries, block_bytes):
    """Small blocks are many in a task."""
    values = texts()
    want, seen = brute(libraries, values)
    docs = prepare(spark).createDataFrame([(i, t, "c", 1, None) for i, t in enumerate(values)], SCHEMA).repartition(3).cache()
    assert rows_of(alignment.alignment(docs, "doc_id", "text", FIRST, SECOND, block_bytes)) == {i: w[:7] for i, w in enumerate(want)}
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.groups) for r in alignment.groups(docs, "doc_id", "text", FIRST, SECOND).collect()}
    assert got == {i: (*w[:3], w[7]) for i, w in enumerate(want)}
    pairs = alignment.pair_counts(docs, "doc_id", "text", FIRST, SECOND).collect()
    assert {(r.a, r.b): r.n for r in pairs} == dict(seen) and len(pairs) == len(seen)


def test_blocks_are_closed_and_joined(libraries, monkeypatch):
    """In one process: two documents of a block each, whose pairs are counted apart."""
    monkeypatch.setattr(alignment, "SLICE_BYTES", 1)
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 5

    monkeypatch.setattr(alignment, "TaskContext", Task)
    names = [c.strip().split()[0] for c in alignment._ROWS.format(id="long").split(", ")]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["the the fox", "fox"])], names=["id", "text"])
    rows = pa.Table.from_batches(alignment._work(FIRST, SECOND, names, True, 1)([batch])).to_pylist()
    assert [(r["id"], r["block"] - (5 << 32)) for r in rows] == [(1, 0), (None, 0), (2, 1), (None, 1)]
    assert [len(r["pairs"] or []) for r in rows] == [0, 3, 0, 2] and rows[1]["documents"] == [1, 1, 1]


def test_long_groups_are_counted_not_listed(spark, libraries):
    """A text whose tokens meet at its ends only would have links as the product of its lengths."""
    found = alignment.links_of(*_one_group(5000, 4000), 32000)
    assert found.to_pydict() == {"doc": [0], "pair": [7 * 32000 + 9], "times": [5000 * 4000]}


def _one_group(n_a, n_b):
    import numpy as np
    import pyarrow as pa

    a = pa.table({"group": np.zeros(n_a, np.int64), "id": np.full(n_a, 7)})
    b = pa.table({"group": np.zeros(n_b, np.int64), "id": np.full(n_b, 9)})
    return a, b, np.zeros(1, np.int64)


def test_nothing_and_nulls(spark):
    llm = prepare(spark)
    assert alignment.alignment(llm.createDataFrame([], SCHEMA), "doc_id", "text", FIRST, SECOND).count() == 0
    rows = [(None, "a b", None, None, None), (None, None, None, None, None)]
    got = alignment.alignment(llm.createDataFrame(rows, SCHEMA), "doc_id", "text", FIRST, SECOND).collect()
    assert sorted((r.n_a, r.n_groups, r.n_best, r.count_sum, len(r.groups_sha256)) for r in got) == [(0, 0, 0, 0, 0), (2, 2, 2, 2, 64)]


def test_query_equals_the_libraries(spark, libraries):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want, _ = brute(libraries, [d.text for d in docs])
    assert rows_of(queries()["op11_alignment"](spark, sf_dir)) == {d.doc_id: w[:7] for d, w in zip(docs, want)}
