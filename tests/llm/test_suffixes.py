"""Repeated passages against brute force, on awkward texts and with pieces cut anywhere."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from __spark_entry__ import queries
from dimflow.llm import suffixes
from dimflow.llm.common import prepare, table

SCHEMA = "doc_id long, text string, spans string, row long, kept string"


def brute(texts: list[str | None], threshold: int) -> list[tuple[int, list[tuple[int, int]], bytes]]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + threshold] for r in raws for i in range(len(r) - threshold + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - threshold + 1):
            if seen[r[i : i + threshold]] > 1:
                gone[i + 1 : i + threshold + 1] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        out.append((len(r), list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(b for b, g in zip(r, gone[1:]) if not g)))
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in df.collect()}


def texts_with_repeats(seed: int, n: int = 120) -> list[str | None]:
    rnd = random.Random(seed)

    def some(k: int) -> str:
        return "".join(rnd.choice("abcdé ") for _ in range(k))

    shared = [some(rnd.randint(10, 90)) for _ in range(8)]
    out = [None, "", "a", "x" * 300, "x" * 31, "xy" * 100, some(5000) + "é"]
    for _ in range(n):
        t = some(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randint(0, len(p))
            t += p[a : a + rnd.randint(0, 90)] + some(rnd.randint(0, 30))
        out.append(t)
    return [*out, out[20], out[20], out[21] + "z"]


@pytest.mark.parametrize(("seed", "threshold", "piece"), [(1, 20, 1 << 20), (2, 33, 64), (3, 9, 17), (4, 2, 1 << 10), (5, 50, 1 << 20)])
def test_equals_brute_force(spark, seed, threshold, piece):
    """Also where texts are worked on in pieces shorter than themselves, which cuts runs in two."""
    texts = texts_with_repeats(seed)
    docs = prepare(spark).createDataFrame([(i, t, "c", 1, None) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    assert found(suffixes.without_repeats(docs, "doc_id", "text", threshold, piece)) == dict(enumerate(brute(texts, threshold)))


def test_runs_cover_each_window_once():
    for piece in (7, 50, 1 << 20):
        raws = [t.encode() for t in texts_with_repeats(6) if t]
        data, bounds = np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)])
        got = Counter()
        for rows, lo, n, anchor, *_ in suffixes.runs_of(data, bounds, 24, piece):
            for r, a, k, p in zip(rows.tolist(), lo.tolist(), n.tolist(), anchor.tolist()):
                got.update((r, s) for s in range(a, a + k))
                assert a + k - 1 <= p <= a + 12
        assert got == Counter((i, s) for i, r in enumerate(raws) for s in range(len(r) - 23))


def test_cuts_begin_where_the_anchor_says():
    rnd = random.Random(3)
    text = np.frombuffer(bytes(rnd.randrange(256) for _ in range(400)), np.uint8)
    lo, n, anchor, ax, _, bx, _ = suffixes.cuts_of(text, np.array([10, 100]), np.array([21, 3]), np.array([40, 117]), 8, 50)
    assert (lo[0], n.sum(), lo[-1] + n[-1]) == (10, 24, 103) and set((anchor[:-1] - lo[:-1]) // 8) == {1, 2, 3}
    # A window's step shares the same bytes, however much of the step a run has.
    part = suffixes.cuts_of(text, np.array([12]), np.array([2]), np.array([40]), 8, 50)
    assert part[3][0] == ax[0] and part[5][0] != bx[0]


def test_rows_of_one_text_and_awkward_tables(spark):
    llm = prepare(spark)
    rows = [(None, "r" * 40 + "tail", None, None, None)] * 3 + [(1, None, None, None, None), (1, "short", None, None, None)]
    got = suffixes.without_repeats(llm.createDataFrame(rows, SCHEMA), "doc_id", "text", 30).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, len(r.spans), bytes(r.kept)) for r in got) == [
        (0, 44, 1, b""), (0, 44, 1, b""), (0, 44, 1, b""), (1, 0, 0, b""), (1, 5, 0, b"short")]
    assert suffixes.without_repeats(llm.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0
    with pytest.raises(ValueError, match="two bytes"):
        suffixes.without_repeats(llm.createDataFrame([], SCHEMA), "doc_id", "text", 1)


def test_many_documents_share_one_passage(spark):
    """A passage of a third of all documents, each with its own surroundings, in which only it repeats."""
    rnd = random.Random(8)
    passage = "".join(rnd.choice("klmnop") for _ in range(90))
    own = ["".join(rnd.choice("abcdefgh") for _ in range(80)) for _ in range(900)]
    texts = [o[:40] + passage + o[40:] if i % 3 == 0 else o for i, o in enumerate(own)]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(suffixes.without_repeats(docs, "doc_id", "text", 60)) == dict(enumerate(brute(texts, 60)))


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = {d.doc_id: w for d, w in zip(docs, brute([d.text for d in docs], 400))}
    got = queries()["op13_repeated_passages"](spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        size, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (size, size - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
