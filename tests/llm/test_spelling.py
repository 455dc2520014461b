"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from __spark_entry__ import queries
from dimflow.llm import spelling
from dimflow.llm.common import prepare, table


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts: dict[str, int]) -> dict[str, tuple]:
    """Neighbours by the words left when one place is masked or deleted."""
    masks: dict[tuple, list[str]] = {}
    for w in counts:
        for i in range(len(w)):
            masks.setdefault(("sub", w[:i], w[i + 1 :]), []).append(w)
    near: dict[str, set[str]] = {w: set() for w in counts}
    for group in masks.values():
        for a, b in combinations(group, 2):
            near[a].add(b)
            near[b].add(a)
    for w in counts:
        for i in range(len(w)):
            v = w[:i] + w[i + 1 :]
            if v in counts:
                near[w].add(v)
                near[v].add(w)
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return {w: (n, len(near[w]), forms[w], counts[forms[w]] if forms[w] else None, root(w)) for w, n in counts.items()}


def found(df) -> dict[str, tuple]:
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def vocabulary(seed: int, n: int = 1500, letters: str = "abcé\U0010ffff") -> dict[str, int]:
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for _ in range(n)}
    words |= {w + rnd.choice(letters) for w in list(words)[:200]} | {"long" * 200 + x for x in ("", "a", "b", "ba")}
    return {w: rnd.choice([3, 3, 4, 9, 30, 100, 1000]) for w in words}


def test_scan_equals_brute_force():
    words = sorted(vocabulary(1, 700))
    index = spelling.SortedWords(words)
    for w in words[::3] + ["", "zzz", "abcab"]:
        for prefix in {0, len(w) // 2, len(w)}:
            want = [v for v in words if v[:prefix] == w[:prefix] and one_edit(w, v)]
            assert [words[i] for i in index.one_edit(w, prefix)] == want, (w, prefix)


def test_scan_skips_what_cannot_match():
    """Of 20,000 words with the same first half, those under a prefix two edits off are not walked."""
    words = sorted(f"prefix{a:03d}{b:03d}" for a in range(20) for b in range(1000))

    class Counted(list):
        walked = 0

        def __getitem__(self, i):
            Counted.walked += 1  # asked once for each word walked to
            return list.__getitem__(self, i)

    index = spelling.SortedWords(words)
    index.shared = Counted(index.shared)
    assert len(index.one_edit("prefix007123", 6)) == 27 + 9 + 1
    assert Counted.walked < 2000


@pytest.mark.parametrize(("seed", "block"), [(2, 50_000), (3, 37), (4, 200)])
def test_variants_equal_brute_force(spark, seed, block):
    """Blocks smaller than a range send a word to several."""
    counts = vocabulary(seed)
    rows = [(n, w, "clash") for w, n in counts.items()] + [(5, None, None)]
    words = prepare(spark).createDataFrame(rows, "n int, word string, key string").repartition(3)
    assert found(spelling.variants(words, block)) == brute(counts)


def test_nothing(spark):
    empty = prepare(spark).createDataFrame([], "doc_id long, text string, word string")
    assert spelling.variants(spelling.word_counts(empty, "doc_id", "text")).count() == 0


def expected_counts(docs: list[tuple], least: int = 5) -> Counter:
    total = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += len(run) >= least
    return +total


def test_word_counts(spark):
    rnd = random.Random(5)
    letters = "abÀéÿ×÷ AZ.ł\n9ß"
    docs = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 2000)))) for i in range(60)]
    docs += [(None, "Words words WORDS"), (None, None), (3, ""), (3, "repeated repeated"), (3, "repeated repeated"), (7, "ab" * 50_000)]
    df = prepare(spark).createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int").repartition(3)
    got = {r.word: r.n for r in spelling.word_counts(df, "doc_id", "text").collect()}
    assert got == expected_counts(docs)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(d.doc_id, d.text) for d in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    counts = {w: n for w, n in expected_counts(docs).items() if n >= 3}
    got = queries()["op12_spelling_variants"](spark, sf_dir)
    assert {"word", "n", "n_near", "form", "form_n", "root"} <= set(got.columns)
    assert found(got) == brute(counts)
