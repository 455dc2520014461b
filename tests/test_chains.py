"""Custody chains against a walk move by move."""

from __future__ import annotations

import random

from dimflow.operators.chains import chain_report, chains
from tests.conftest import rows

SCHEMA = "b string, m int, f string, t string"


def walked(moves):
    out = {}
    for b, m, f, t in moves:
        def before(move):
            return [x for x in moves if x[0] == b and move[2] is not None and x[3] == move[2]]

        place, at, seen = 0, (b, m, f, t), set()
        first = None
        while at[1] not in seen:
            seen.add(at[1])
            prior = before(at)
            if len(prior) != 1:
                first = at[1]
                break
            at, place = prior[0], place + 1
        own = before((b, m, f, t))
        kind = "start" if f is None else "gap" if not own else "merge" if len(own) > 1 else "link"
        out[b, m] = (own[0][1] if kind == "link" else None, kind, sum(x[0] == b and x[2] == t for x in moves), first, None if first is None else place, first is None)
    return out


def by_hand(spark, moves):
    df = chains(spark.createDataFrame(moves, SCHEMA), "b", "m", "f", "t")
    got = {(r["batch"], r["move"]): (r["follows"], r["kind"], r["n_next"], r["first"], r["place"], r["in_cycle"]) for r in df.collect()}
    return df, got


def test_each_kind(spark):
    moves = [
        ("a", 1, None, "x"), ("a", 2, "x", "y"), ("a", 3, "y", "z"), ("a", 4, "y", "w"),  # a fork
        ("a", 5, "lost", "q"), ("a", 6, "q", "r"),  # a gap
        ("b", 1, "k", "l"), ("b", 2, "l", "k"), ("b", 3, "l", "o"), ("b", 4, "s", "s"),  # cycles, one left by a branch
        ("c", 1, None, "x"), ("c", 2, None, "x"), ("c", 3, "x", "y"),  # a merge
    ]
    df, got = by_hand(spark, moves)
    assert got == walked(moves)
    assert rows(chain_report(df)) == [("a", 6, 2, 1, 0, 1, 0, 3), ("b", 4, 0, 0, 0, 1, 4, 0), ("c", 3, 3, 0, 1, 0, 0, 1)]


def test_random_moves_and_long_chains(spark):
    rnd = random.Random(7)
    moves = [(f"b{i % 9}", i, rnd.choice([None, *"nopqrstuvwxyz"]), rnd.choice("nopqrstuvwxyz")) for i in range(80)]
    moves += [("long", i, f"n{i}" if i else None, f"n{i + 1}") for i in range(300)]
    moves += [("round", i, f"n{i}", f"n{(i + 1) % 40}") for i in range(40)]
    _, got = by_hand(spark, moves)
    assert got == walked(moves)
    assert got["long", 299][3:] == (0, 299, False) and got["round", 5][5]


def test_many_moves_over_one_node_are_counted_not_paired(spark):
    moves = spark.range(20_000).selectExpr("'b' as b", "cast(id as int) as m", "if(id % 2 = 0, 'x', 'y') as f", "if(id % 2 = 0, 'y', 'x') as t")
    df = chains(moves, "b", "m", "f", "t")
    assert rows(df.groupBy("kind", "n_next", "place").count()) == [("merge", 10_000, 0, 20_000)]


def test_nothing(spark):
    df, got = by_hand(spark, [])
    assert got == {} and chain_report(df).count() == 0
