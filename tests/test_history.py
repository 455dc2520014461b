"""Dimensions that grow by waves in the store."""

from __future__ import annotations

import random
from datetime import datetime
from pathlib import Path

import pytest

from dimflow.operators import versioned
from dimflow.sources.history import WaveCounts, apply_wave, replace_current, stable_keys
from dimflow.sources.store import ANALYTICS
from tests.conftest import rows


def snapshot(spark, data, schema="code string, region int"):
    return spark.createDataFrame(data, schema)


def wave(store, incoming, month, buckets=4):
    return apply_wave(store, ANALYTICS, "dim", incoming, "x_key", "code", ["region"], f"2026-{month:02d}-01 00:00:00", buckets=buckets)


def files(store, name="dim"):
    return {str(p): p.stat().st_mtime_ns for p in Path(store.root, ANALYTICS, name).rglob("*.parquet") if "commits" not in str(p)}


def test_stored_waves_equal_the_operator_wave_by_wave(spark, store):
    rnd, dim, known = random.Random(4), None, {}
    for month in range(1, 5):
        for _ in range(12):
            known[f"k{rnd.randint(0, 40)}"] = rnd.randint(0, 3)
        incoming = snapshot(spark, sorted(known.items()))
        made = versioned.apply_snapshot(dim, incoming, "x_key", "code", ["region"], f"2026-{month:02d}-01 00:00:00")
        counts = wave(store, incoming, month)
        assert (counts.n_new_versions, counts.n_expired) == tuple(made.summary().first())
        dim = spark.createDataFrame(made.dim.collect(), made.dim.schema)
        assert rows(store.read(ANALYTICS, "dim")) == rows(dim)
        assert rows(store.current(ANALYTICS, "dim")) == rows(dim.where("is_current"))


def test_a_wave_leaves_closed_versions_and_other_buckets_alone(spark, store):
    data = {f"k{i}": 0 for i in range(40)}
    wave(store, snapshot(spark, list(data.items())), 1)
    wave(store, snapshot(spark, list({**data, "k1": 1}.items())), 2)
    before, commit = files(store), store.commit(ANALYTICS, "dim")
    assert commit.kept == [1] and sorted(commit.live.values()) == [0, 0, 0, 1]
    reader = store.current(ANALYTICS, "dim")
    assert wave(store, snapshot(spark, list({**data, "k1": 2}.items())), 3) == WaveCounts(1, 1)
    after, commit = files(store), store.commit(ANALYTICS, "dim")
    assert before.items() <= after.items()  # nothing that was there is touched
    assert commit.kept == [1, 2] and sorted(commit.live.values()) == [0, 0, 0, 2] and commit.last_key == 42
    assert reader.count() == 40
    assert rows(store.deltas(ANALYTICS, "dim", 1)) == [("k1", 42, datetime(2026, 3, 1), "changed")]
    assert store.deltas(ANALYTICS, "dim", 2) is None


def test_the_closed_part_is_not_in_a_waves_plan(spark, store):
    for month, region in ((1, 0), (2, 1)):
        wave(store, snapshot(spark, [("a", region), ("b", 0)]), month)
    read = versioned.classify(store.current(ANALYTICS, "dim"), snapshot(spark, [("a", 1)]), "code", ["region"]).inputFiles()
    assert read and not any("/kept=" in file for file in read)
    assert any("/kept=" in file for file in store.read(ANALYTICS, "dim").inputFiles())


def test_nothing_changed_commits_nothing(spark, store):
    for _ in range(2):
        wave(store, snapshot(spark, [("a", 1)]), 1)
    assert store.commit(ANALYTICS, "dim").generation == 0


def test_repeated_keys_backward_dates_and_other_columns_are_refused(spark, store):
    with pytest.raises(ValueError, match="code a more than once"):
        wave(store, snapshot(spark, [("a", 1), ("a", 2)]), 1)
    assert not store.exists(ANALYTICS, "dim")
    wave(store, snapshot(spark, [("a", 1), ("b", 1)]), 2)
    wave(store, snapshot(spark, [("a", 2), ("b", 1)]), 3)
    state = rows(store.read(ANALYTICS, "dim"))
    with pytest.raises(ValueError, match="code b more than once"):
        wave(store, snapshot(spark, [("b", 3), ("b", 4)]), 4)
    with pytest.raises(Exception, match="not later than"):
        wave(store, snapshot(spark, [("a", 5)]), 3)
    with pytest.raises(ValueError, match="calls for"):
        wave(store, snapshot(spark, [("a", 5, 1)], "code string, region int, extra int"), 5)
    with pytest.raises(ValueError, match="another bucketing"):
        wave(store, snapshot(spark, [("a", 6)]), 6, buckets=7)
    assert rows(store.read(ANALYTICS, "dim")) == state


def test_a_wave_of_new_keys_only_and_an_empty_first_one(spark, store):
    assert wave(store, snapshot(spark, []), 1) == WaveCounts(0, 0)
    assert store.read(ANALYTICS, "dim").count() == 0
    assert wave(store, snapshot(spark, [("a", 1)]), 2) == WaveCounts(1, 0)
    assert store.commit(ANALYTICS, "dim").kept == [] and rows(store.read(ANALYTICS, "dim").select("x_key", "code")) == [(1, "a")]


def test_first_snapshot_with_a_repeated_key_is_refused_by_the_operator(spark):
    with pytest.raises(ValueError, match="more than once"):
        versioned.initial_load(snapshot(spark, [("a", 1), ("a", 2)]), "x_key", "code")


def keyed(store, spark, ids):
    frame = spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string")
    return {r.id: r.k for r in stable_keys(store, ANALYTICS, "dim_keys", frame, "k", ["id"]).collect()}


def test_keys_stay_when_rows_come_between_go_and_return(spark, store):
    first = keyed(store, spark, [10, 20, 30])
    assert first == {10: 1, 20: 2, 30: 3}
    assert keyed(store, spark, [5, 10, 15, 30]) == {5: 4, 10: 1, 15: 5, 30: 3}
    assert keyed(store, spark, [20, 5, 1]) == {20: 2, 5: 4, 1: 6}
    before = files(store, "dim_keys")
    assert keyed(store, spark, [20]) == {20: 2} and files(store, "dim_keys") == before


def test_keys_of_composite_ids_and_of_bad_ones(spark, store):
    schema = "a int, b string, c int"
    frame = spark.createDataFrame([(1, "x", 0), (1, "y", 0), (2, "x", 0)], schema)
    assert rows(stable_keys(store, ANALYTICS, "pairs", frame, "k", ["a", "b"])) == [(1, 1, "x", 0), (2, 1, "y", 0), (3, 2, "x", 0)]
    with pytest.raises(ValueError, match="there 2 times"):
        stable_keys(store, ANALYTICS, "pairs", frame.unionAll(frame), "k", ["a", "b"])
    with pytest.raises(Exception, match="NULL in key column b"):
        stable_keys(store, ANALYTICS, "pairs", spark.createDataFrame([(1, None, 0)], schema), "k", ["a", "b"])
    empty = stable_keys(store, ANALYTICS, "none", frame.limit(0), "k", ["a", "b"])
    assert empty.columns == ["k", "a", "b", "c"] and empty.count() == 0


def test_a_replaced_dimension_knows_which_ids_came_and_went(spark, store):
    for ids in ([1, 2], [2, 3]):
        replace_current(store, ANALYTICS, "dim", spark.createDataFrame([(i, i) for i in ids], "k int, id int"), "id")
    assert rows(store.deltas(ANALYTICS, "dim", 0)) == [(1,), (3,)]
