"""Differences between two copies of a table, and repairs."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dimflow.operators import digests
from dimflow.operators.digests import Ranges, branch_digests, diff_rows, differing_leaves, leaf_digests, within
from dimflow.registry import TableSpec
from dimflow.session import materialise
from dimflow.sources import load
from dimflow.sources.load import Repaired
from dimflow.sources.store import RAW
from tests.conftest import plan, rows

SCHEMA = "id long, name string, v double"
BY_ID, BY_HASH = Ranges(("id",), width=10, fanout=4), Ranges(("id",), leaves=97, fanout=8)


def two_copies(spark, seed, n=400):
    rnd = random.Random(seed)
    left = {i: (i, rnd.choice(["a", "b|", None, ""]), rnd.random()) for i in rnd.sample(range(-n, n), n)}
    right, want = dict(left), {}
    for i in rnd.sample(sorted(left), 12):
        right[i], want[i] = (i, "other", left[i][2]), "changed"
    for i in rnd.sample(sorted(set(left) - set(want)), 9):
        del right[i]
        want[i] = "missing"
    for i in range(5 * n, 5 * n + 7):
        right[i], want[i] = (i, "a", 0.0), "extra"
    return *(spark.createDataFrame(list(d.values()), SCHEMA).repartition(3) for d in (left, right)), want


@pytest.mark.parametrize("ranges", [BY_ID, BY_HASH, Ranges(("id",), width=1), Ranges(("id",), leaves=1)])
def test_differences_are_named_key_by_key(spark, ranges):
    source, target, want = two_copies(spark, 1)
    assert dict(rows(diff_rows(source, target, ranges))) == want


@pytest.mark.parametrize("most", [0, 200])
def test_leaves_are_filters_or_joined(spark, monkeypatch, most):
    monkeypatch.setattr(digests, "MOST_LEAVES", most)
    source, target, want = two_copies(spark, 2)
    assert dict(rows(diff_rows(source, target, BY_ID))) == want


def test_equal_copies_have_no_differing_leaf(spark):
    source, _, _ = two_copies(spark, 3)
    assert differing_leaves(source, source.orderBy("v"), BY_ID).count() == 0
    assert diff_rows(source, source, BY_HASH).count() == 0
    empty = source.limit(0)
    assert diff_rows(empty, empty, BY_ID).count() == 0
    assert diff_rows(empty, source, BY_ID).where("difference = 'extra'").count() == source.count()


def test_branches_fold_leaves(spark):
    source, _, _ = two_copies(spark, 4)
    whole = branch_digests(leaf_digests(source, Ranges(("id",), width=10, fanout=1 << 40)), Ranges(("id",), width=10, fanout=1 << 40))
    again = branch_digests(leaf_digests(source, Ranges(("id",), width=3, fanout=1 << 40)), Ranges(("id",), width=3, fanout=1 << 40))
    columns = ["_n", "_hi", "_lo", "_hi_sum", "_lo_sum"]
    fold = [F.sum("_n"), F.bit_xor("_hi"), F.bit_xor("_lo"), F.sum("_hi_sum"), F.sum("_lo_sum")]
    assert rows(whole.select(*columns).agg(*fold)) == rows(again.select(*columns).agg(*fold))


def test_null_and_repeated_keys_and_several_columns(spark):
    schema = "a int, b string, v int"
    source = spark.createDataFrame([(None, "x", 1), (1, None, 1), (1, "y", 1), (1, "y", 1), (2, "z", 5)], schema)
    target = spark.createDataFrame([(None, "x", 2), (1, None, 1), (1, "y", 1), (2, "z", 5), (2, None, 0)], schema)
    assert rows(diff_rows(source, target, Ranges(("a", "b"), leaves=5))) == [
        (None, "x", "changed"), (1, "y", "changed"), (2, None, "extra")]
    null = spark.createDataFrame([(None, "n", 1.0)], SCHEMA)
    assert rows(diff_rows(null, null.limit(0), BY_ID)) == [(None, "missing")]


def test_bad_ranges_are_refused():
    for bad in (lambda: Ranges(("a", "b"), width=5), lambda: Ranges(("a",), width=0)):
        with pytest.raises(ValueError, match="one key"):
            bad()


def test_ranges_reach_the_scan(spark, tmp_path):
    source, target, _ = two_copies(spark, 5)
    source.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    leaves = materialise(differing_leaves(stored, stored.where("id not between 20 and 39 and id <> 77"), BY_ID), "leaves")
    assert rows(leaves) == [(n,) for n in (2, 3, 7) if stored.where(f"id div 10 = {n} and id > 0").count()]
    text = plan(within(stored, BY_ID, leaves))
    assert "GreaterThanOrEqual(id,20)" in text and "LessThan(id,40)" in text


D1, D2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
SPEC = TableSpec("t", ("id",), incremental=True, id_range=100)


def dated(spark, values):
    return spark.createDataFrame([(i, v, d) for i, (v, d) in values.items()], "id long, v string, updated_at timestamp_ntz")


def test_a_repair_finds_what_no_stamp_tells(spark, store):
    values = {i: ("a", D2) for i in range(500)}
    load.run(store, lambda name: dated(spark, values), [SPEC])
    values[5], values[7] = ("silent", D2), ("backdated", D1)
    values[-3] = ("late", D1)
    del values[450]
    source = lambda name: dated(spark, values)
    assert load.load_incremental(store, source, SPEC) == 0
    assert load.repair(store, source, SPEC, Ranges(("id",), width=10, fanout=8)) == Repaired(2, 1, 1)
    assert rows(store.read(RAW, "t")) == sorted((i, *v) for i, v in values.items())
    # Ranges that agree stay as they are, and what was done is there for derived tables.
    assert store.commit(RAW, "t").live == {-1: 1, 0: 1, 1: 0, 2: 0, 3: 0, 4: 1}
    assert rows(store.deltas(RAW, "t", 0).select("id", "_gone")) == [(-3, False), (5, False), (7, False), (450, True)]
    before = store.commit(RAW, "t")
    assert load.repair(store, source, SPEC) == Repaired() and store.commit(RAW, "t") == before


def test_a_repair_reads_again_only_ranges_that_differ(spark, store):
    """Of the rows asked for after the digests, those of ranges that agree would raise an error."""
    values = {i: ("a", D2) for i in range(300)}
    load.run(store, lambda name: dated(spark, values), [SPEC])
    values[42] = ("b", D2)
    rows_ = dated(spark, values)
    leaves = materialise(differing_leaves(rows_, store.read(RAW, "t"), BY_ID), "leaves")
    assert rows(leaves) == [(4,)]
    trapped = rows_.withColumn("v", F.when(F.col("id").between(40, 49), F.col("v")).otherwise(F.raise_error(F.lit("read"))))
    assert rows(within(trapped, BY_ID, leaves).select("id", "v")) == [(i, "b" if i == 42 else "a") for i in range(40, 50)]
    with pytest.raises(Exception, match="read"):
        trapped.collect()


def test_a_table_emptied_at_the_source_and_one_that_was_empty(spark, store):
    load.run(store, lambda name: dated(spark, {1: ("a", D1)}), [SPEC])
    empty = dated(spark, {1: ("a", D1)}).limit(0)
    assert load.repair(store, lambda name: empty, SPEC) == Repaired(extra=1) and store.read(RAW, "t").count() == 0
    assert load.repair(store, lambda name: dated(spark, {1: ("a", D1)}), SPEC) == Repaired(missing=1)
    assert rows(store.read(RAW, "t")) == [(1, "a", D1)]
