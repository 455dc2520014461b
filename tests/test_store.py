from __future__ import annotations

import os
from collections import Counter
from dataclasses import replace
from datetime import datetime
from types import SimpleNamespace

import pytest

from dimflow.registry import TableSpec, by_name
from dimflow.session import shared_folder
from dimflow.sources import load
from dimflow.sources import store as table_store
from dimflow.sources.readers import parquet_source
from dimflow.sources.store import RAW
from tests.conftest import rows

SPEC = TableSpec("widgets", ("id",), incremental=True, buckets=4)
SCHEMA = "id int, name string, updated_at timestamp_ntz"
D1, D2, D3 = (datetime(2026, 1, d) for d in (1, 2, 3))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_first_load_pulls_everything_and_sets_the_mark(spark, store):
    source = lambda name: frame(spark, (1, "a", D1), (2, "b", D2))
    assert load.load_incremental(store, source, SPEC) == 2
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1), (2, "b", D2)]
    assert rows(store.marks(RAW, ["widgets", "other"])) == [("widgets", D2)]


def test_second_load_pulls_nothing(spark, store):
    source = lambda name: frame(spark, (1, "a", D1), (2, "b", D2))
    load.load_incremental(store, source, SPEC)
    before = store.commit(RAW, "widgets")
    assert load.load_incremental(store, source, SPEC) == 0
    assert store.commit(RAW, "widgets") == before


def test_changed_row_replaces_the_old_one(spark, store):
    load.load_incremental(store, lambda name: frame(spark, (1, "a", D1), (2, "b", D1)), SPEC)
    load.load_incremental(store, lambda name: frame(spark, (1, "A", D2), (2, "b", D1)), SPEC)
    assert rows(store.read(RAW, "widgets")) == [(1, "A", D2), (2, "b", D1)]


def test_change_without_a_new_stamp_is_not_seen(spark, store):
    load.load_incremental(store, lambda name: frame(spark, (1, "a", D1)), SPEC)
    load.load_incremental(store, lambda name: frame(spark, (1, "silent", D1)), SPEC)
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1)]


def test_rows_at_the_mark_can_be_pulled_again(spark, store):
    load.load_incremental(store, lambda name: frame(spark, (1, "a", D1)), SPEC)
    late = lambda name: frame(spark, (1, "a", D1), (2, "late", D1))
    assert load.load_incremental(store, late, SPEC) == 0
    assert load.load_incremental(store, late, SPEC, inclusive=True) == 2
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1), (2, "late", D1)]


def test_only_touched_buckets_are_rewritten(spark, store):
    spec = TableSpec("widgets", ("id",), incremental=True, id_range=10)
    store.upsert(RAW, spec, frame(spark, *[(i, "a", D1) for i in range(-5, 30)]))
    store.upsert(RAW, spec, frame(spark, (12, "b", D2)))
    assert store.commit(RAW, "widgets").live == {-1: 0, 0: 0, 1: 1, 2: 0}
    assert os.listdir(f"{store.root}/raw/widgets/gen=1") and not os.path.exists(f"{store.root}/raw/widgets/gen=1/_b=0")
    found = rows(store.read(RAW, "widgets"))
    assert len(found) == 35 and (12, "b", D2) in found
    assert store.superseded(RAW, "widgets") == [f"{store.root}/raw/widgets/gen=0/_b=1"]


def test_composite_keys_can_be_bucketed_by_one_of_their_ids(spark, store):
    spec = TableSpec("links", ("name", "id"), incremental=True, id_range=10, range_key="id")
    store.upsert(RAW, spec, frame(spark, (1, "a", D1), (11, "a", D1), (11, "b", D1)))
    store.upsert(RAW, spec, frame(spark, (11, "b", D2)))
    assert store.commit(RAW, "links").live == {0: 0, 1: 1}
    assert rows(store.read(RAW, "links")) == [(1, "a", D1), (11, "a", D1), (11, "b", D2)]


def test_write_that_never_committed_leaves_the_table_as_it_was(spark, store):
    store.upsert(RAW, SPEC, frame(spark, (1, "a", D1)))
    frame(spark, (9, "half written", D3)).write.parquet(f"{store.root}/raw/widgets/gen=1/_b=0")
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1)]
    store.upsert(RAW, SPEC, frame(spark, (2, "b", D2)))
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1), (2, "b", D2)]


def test_replace_keeps_only_the_new_rows_and_readers_keep_the_old(spark, store):
    store.replace(RAW, "t", frame(spark, (1, "a", D1)))
    reader = store.read(RAW, "t")
    store.replace(RAW, "t", reader.withColumn("name", reader.id.cast("string")))
    assert rows(reader) == [(1, "a", D1)]
    assert rows(store.read(RAW, "t")) == [(1, "1", D1)]
    assert store.superseded(RAW, "t") == [f"{store.root}/raw/t/gen=0"]


def test_batch_of_another_shape_is_refused(spark, store):
    store.upsert(RAW, SPEC, frame(spark, (1, "a", D1)))
    with pytest.raises(ValueError, match="extra \\['x'\\]"):
        store.upsert(RAW, SPEC, frame(spark, (1, "a", D2)).selectExpr("*", "1 as x"))


def test_reading_what_was_never_written_is_an_error(store):
    assert store.find(RAW, "nothing") is None and not store.exists(RAW, "nothing")
    with pytest.raises(LookupError):
        store.read(RAW, "nothing")


def test_registry_drives_the_load(spark, store, tmp_path):
    frame(spark, (1, "a", D1), (2, "b", D2)).write.parquet(str(tmp_path / "src" / "widgets.parquet"))
    spark.createDataFrame([(1, "x")], "k int, n string").write.parquet(str(tmp_path / "src" / "lookup.parquet"))
    specs = [SPEC, TableSpec("lookup", ("k",))]
    source = parquet_source(spark, str(tmp_path / "src"), {"lookup": "k int, n string"})
    assert rows(load.run(store, source, specs)) == [("lookup", "replace", 1), ("widgets", "incremental", 2)]
    assert rows(load.run(store, source, specs)) == [("lookup", "replace", 1), ("widgets", "incremental", 0)]


def test_specs_are_checked():
    with pytest.raises(ValueError, match="at least one key"):
        TableSpec("t", ())
    with pytest.raises(ValueError, match="name the range_key"):
        TableSpec("t", ("a", "b"), id_range=10)
    with pytest.raises(ValueError, match="one of the keys"):
        TableSpec("t", ("a", "b"), id_range=10, range_key="c")
    assert TableSpec("t", ("a",), id_range=10).range_key == "a"
    with pytest.raises(ValueError, match="twice"):
        by_name([SPEC, SPEC])
    assert by_name([SPEC]) == {"widgets": SPEC}


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_that_names_no_shared_folder_is_refused():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:7077")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)
    context.master = "local-cluster[2,1,1024]"  # its executors are machines of their own to Spark
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)
    context.getCheckpointDir = lambda: "hdfs:///shared/"
    assert shared_folder(session) == "hdfs:///shared"


def test_null_key_leaves_the_table_as_it_was(spark, store):
    from pyspark.errors import PySparkException

    for spec in (SPEC, TableSpec("widgets", ("id",), incremental=True, buckets=4, unique=True)):
        with pytest.raises(PySparkException, match="NULL in key column id"):
            store.upsert(RAW, spec, frame(spark, (None, "a", D1)))
    assert not store.exists(RAW, "widgets")


def test_copies_in_a_batch_give_one_row_and_an_empty_first_batch_none(spark, store):
    assert store.upsert(RAW, SPEC, frame(spark, (1, "a", D1)).where("id > 1")) == 0
    assert not store.exists(RAW, "widgets")
    assert store.upsert(RAW, SPEC, frame(spark, (1, "new", D2), (1, "old", D1), (2, "b", D1))) == 2
    assert rows(store.read(RAW, "widgets")) == [(1, "new", D2), (2, "b", D1)]


def test_changed_bucketing_keeps_every_row(store, spark):
    def batch(ids, value):
        return spark.createDataFrame([(i, value) for i in ids], "id int, value string")

    store.upsert(RAW, TableSpec("t", ("id",), incremental=True), batch(range(200), "old"))
    for spec in (TableSpec("t", ("id",), incremental=True, buckets=16), TableSpec("t", ("id",), incremental=True, id_range=50)):
        store.upsert(RAW, spec, batch((3, 77, 150), "new"))
        kept = {r.id: r.value for r in store.read(RAW, "t").collect()}
        assert store.read(RAW, "t").count() == len(kept) == 200
        assert {i for i, v in kept.items() if v == "new"} == {3, 77, 150}


def test_newer_stored_row_stays(store, spark):
    spec = TableSpec("t", ("id",), incremental=True)
    for value, day in (("new", 3), ("late", 1), ("same", 3)):
        rows_ = [(1, value, datetime(2026, 1, day)), (2, value, None)]
        store.upsert(RAW, spec, spark.createDataFrame(rows_, "id int, value string, updated_at timestamp_ntz"))
        stored = {r.id: r.value for r in store.read(RAW, "t").collect()}
        assert stored[1] == {"new": "new", "late": "new", "same": "same"}[value] and stored[2] == value


def ids(spark, numbers, name="a", day=D1):
    return frame(spark, *[(i, name, day) for i in numbers])


def test_a_bucket_over_its_size_is_split_alone(spark, store):
    spec = TableSpec("widgets", ("id",), incremental=True, split_rows=50)
    store.upsert(RAW, spec, ids(spark, range(160)))
    first = store.commit(RAW, "widgets")
    assert all(g == 0 for g in first.live.values()) and len(first.live) >= 4
    sizes = bucket_sizes(store)
    assert max(sizes.values()) <= 50 and sum(sizes.values()) == 160
    # Ids of one bucket until it is over its size.
    target = max(sizes, key=sizes.get)
    some = spark.range(1000, 4000).selectExpr("cast(id as int) as id")
    from dimflow.sources.store import _bucket

    same = [r.id for r in some.where(_bucket(spec, first.live) == target).limit(60).collect()]
    store.upsert(RAW, spec, ids(spark, same, "b", D2))
    second = store.commit(RAW, "widgets")
    assert {b: g for b, g in second.live.items() if b in first.live} == {b: 0 for b in first.live if b != target}
    assert len(second.live) > len(first.live) and max(bucket_sizes(store).values()) <= 50
    assert [r[0] for r in rows(store.read(RAW, "widgets"))] == sorted([*range(160), *same])


def bucket_sizes(store):
    commit = store.commit(RAW, "widgets")
    live = {b: g for b, g in commit.live.items() if g >= 0}
    return {b: store.spark.read.parquet(f"{store.root}/raw/widgets/gen={g}/_b={b}").count() for b, g in live.items()}


def test_a_table_that_is_split_from_nothing_and_emptied(spark, store):
    spec = TableSpec("widgets", ("id",), incremental=True, split_rows=10)
    store.create(RAW, spec, frame(spark, (1, "a", D1)).schema)
    assert store.read(RAW, "widgets").count() == 0
    for start in range(0, 120, 40):
        store.upsert(RAW, spec, ids(spark, range(start, start + 40)))
    assert len(rows(store.read(RAW, "widgets"))) == 120 and max(bucket_sizes(store).values()) <= 10
    gone = ids(spark, range(120))
    store.upsert(RAW, spec, gone.limit(0), gone=gone)
    assert store.read(RAW, "widgets").count() == 0
    store.upsert(RAW, spec, ids(spark, [5], "again"))
    assert rows(store.read(RAW, "widgets")) == [(5, "again", D1)]


def test_a_table_can_change_to_split_buckets(spark, store):
    store.upsert(RAW, SPEC, ids(spark, range(90)))
    spec = TableSpec("widgets", ("id",), incremental=True, split_rows=20)
    store.upsert(RAW, spec, ids(spark, [5], "b", D2))
    kept = rows(store.read(RAW, "widgets"))
    assert len(kept) == 90 and kept[5] == (5, "b", D2) and max(bucket_sizes(store).values()) <= 20
    with pytest.raises(ValueError, match="without id_range"):
        TableSpec("t", ("id",), split_rows=5, id_range=5)


def test_many_small_buckets_share_directories(spark, store):
    """Two thousand buckets of a few rows are split one by one, but are written as some tens of directories."""
    spec = TableSpec("widgets", ("id",), incremental=True, split_rows=4)
    numbers = spark.range(6000).selectExpr("cast(id as int) as id", "'a' as name", "timestamp_ntz'2026-01-01' as updated_at")
    store.upsert(RAW, spec, numbers)
    first, places = store.commit(RAW, "widgets"), store.places(RAW, "widgets")
    assert len(first.live) > 1500 and len({p for p in places if p.startswith("gen=0/")}) == len(places) <= 64
    assert placed(store, spec) == Counter({b: n for b, n in placed(store, spec).items() if n <= 4 and b in first.live})
    store.upsert(RAW, spec, ids(spark, [77, 7000], "b", D2))
    second = store.commit(RAW, "widgets")
    stayed = {b for b, g in second.live.items() if g == 0}
    assert len(stayed) > 1400 and set(second.live.values()) <= {0, 1, -1} and len(store.superseded(RAW, "widgets")) <= 2
    assert max(placed(store, spec).values()) <= 4
    got = {r.id: r.name for r in store.read(RAW, "widgets").collect()}
    assert store.read(RAW, "widgets").count() == len(got) == 6001
    assert {i for i, name in got.items() if name == "b"} == {77, 7000}


def placed(store, spec):
    from dimflow.sources.store import _bucket

    live = store.commit(RAW, spec.name).live
    found = store.read(RAW, spec.name).select(_bucket(spec, live).alias("b")).collect()
    return Counter(r.b for r in found)


def test_declared_unique_but_not(spark, store):
    spec = TableSpec("widgets", ("id",), incremental=True, unique=True)
    with pytest.raises(ValueError, match=r"\(1,\) 2 times"):
        store.upsert(RAW, spec, frame(spark, (1, "a", D1), (1, "b", D2)))
    assert not store.exists(RAW, "widgets")


def test_rows_at_or_past_a_mark_by_the_registry(spark, store):
    spec = TableSpec("widgets", ("id",), incremental=True, inclusive=True, cap_at="2026-01-02 12:00:00")
    load.run(store, lambda name: frame(spark, (1, "a", D1), (2, "future", D3)), [spec])
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1)]
    load.run(store, lambda name: frame(spark, (1, "a", D1), (3, "late", D1), (4, "b", D2)), [spec])
    assert [r[0] for r in rows(store.read(RAW, "widgets"))] == [1, 3, 4]


def test_deltas_say_what_a_commit_touched(spark, store):
    store.upsert(RAW, SPEC, ids(spark, range(5)))
    assert store.deltas(RAW, "widgets", 0) is None
    store.upsert(RAW, SPEC, ids(spark, [2, 9], "b", D2))
    store.upsert(RAW, SPEC, ids(spark, [1], "c", D3))
    assert rows(store.deltas(RAW, "widgets", 0).select("id", "name")) == [(1, "c"), (2, "b"), (9, "b")]
    assert rows(store.deltas(RAW, "widgets", 1).select("id")) == [(1,)]
    assert f"{store.root}/raw/widgets/delta=1" in store.superseded(RAW, "widgets", consumed=1)
    assert not any("delta=" in path for path in store.superseded(RAW, "widgets"))


@pytest.mark.parametrize("split_rows", [None, 1000])
def test_rows_are_moved_by_key_only_where_keys_repeat(spark, store, monkeypatch, split_rows):
    moved = []
    for name in ("latest_per_key", "older_than"):
        was = getattr(table_store, name)
        monkeypatch.setattr(table_store, name, lambda *a, name=name, was=was: moved.append(name) or was(*a))
    spec = replace(SPEC, split_rows=split_rows)
    store.upsert(RAW, spec, frame(spark, (1, "a", D1), (2, "b", D2)))
    store.upsert(RAW, spec, frame(spark, (2, "B", D2), (3, "c", D3)))
    assert moved == []
    store.upsert(RAW, spec, frame(spark, (2, "old", D1), (3, "C", D3), (3, "c", D2), (4, "d", D3), (4, "e", D3)))
    assert moved == ["latest_per_key", "older_than"]
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1), (2, "B", D2), (3, "C", D3), (4, "e", D3)]
    assert rows(store.deltas(RAW, "widgets", 1)) == [(2, "old", D1), (3, "C", D3), (4, "e", D3)]


def test_a_first_batch_with_repeated_keys_keeps_the_latest(spark, store):
    assert store.upsert(RAW, SPEC, frame(spark, (1, "a", D1), (1, "b", D2), (2, "c", None), (2, "c", None))) == 2
    assert rows(store.read(RAW, "widgets")) == [(1, "b", D2), (2, "c", None)]


def test_unstamped_rows_meet_stored_stamps(spark, store):
    store.upsert(RAW, SPEC, frame(spark, (1, "a", D1), (2, "b", None)))
    store.upsert(RAW, SPEC, frame(spark, (1, "x", None), (2, "y", None), (3, "z", None)))
    assert rows(store.read(RAW, "widgets")) == [(1, "a", D1), (2, "y", None), (3, "z", None)]
