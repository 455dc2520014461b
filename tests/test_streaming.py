from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

from dimflow.registry import TableSpec
from dimflow.sources.store import RAW
from dimflow.streaming import upsert_stream
from tests.conftest import rows

SPEC = TableSpec("events", ("id",), incremental=True, updated_at="ts", buckets=4)
SCHEMA = "id int, v string, ts timestamp_ntz"
DAY = datetime(2026, 1, 1)


def batch(spark, ids, value, hours):
    return spark.createDataFrame([(i, value, DAY + timedelta(hours=hours)) for i in ids], SCHEMA)


def test_stream_gives_the_table_the_batches_give(spark, store, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    waves = [(range(10), "a", 0), (range(5, 15), "b", 1), (range(12, 20), "c", 2)]
    for ids, value, hours in waves:
        batch(spark, ids, value, hours).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        upsert_stream(stream, store, RAW, SPEC, checkpoint).awaitTermination()
    want = [(i, "a" if i < 5 else "b" if i < 12 else "c") for i in range(20)]
    assert rows(store.read(RAW, "events").select("id", "v")) == want
    assert rows(store.marks(RAW, ["events"])) == [("events", DAY + timedelta(hours=2))]

    before = store.commit(RAW, "events")
    stream = spark.readStream.schema(SCHEMA).parquet(landing)
    upsert_stream(stream, store, RAW, SPEC, checkpoint).awaitTermination()
    assert store.commit(RAW, "events") == before


def test_replayed_micro_batches_change_nothing(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    batch(spark, range(10), "a", 0).write.parquet(landing)
    for attempt in range(2):  # the second one has lost its checkpoint
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        upsert_stream(stream, store, RAW, SPEC, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
    assert rows(store.read(RAW, "events").select("id", "v")) == [(i, "a") for i in range(10)]


def test_each_batch_is_committed_with_its_query_and_number(spark, store, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    for hours in range(2):
        batch(spark, range(10), f"v{hours}", hours).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        query = upsert_stream(stream, store, RAW, SPEC, checkpoint)
        query.awaitTermination()
        assert store.commit(RAW, "events").streams == {query.id: hours}


def test_a_replayed_batch_writes_nothing_and_a_later_one_does(spark, store):
    first, second = batch(spark, range(10), "a", 0), batch(spark, range(5), "b", 1)
    assert store.upsert(RAW, SPEC, first, stream=("q", 0)) == 10 and store.upsert(RAW, SPEC, second, stream=("q", 1)) == 5
    files = sorted(Path(store.root).rglob("*"))
    for rows_, number in ((batch(spark, range(10), "other", 9), 0), (second, 1)):
        assert store.upsert(RAW, SPEC, rows_, stream=("q", number)) == 0
    assert sorted(Path(store.root).rglob("*")) == files
    assert store.upsert(RAW, SPEC, batch(spark, [], "x", 0), stream=("q", 2)) == 0
    assert store.upsert(RAW, SPEC, batch(spark, [7], "c", 2), stream=("other", 0)) == 1
    assert store.commit(RAW, "events").streams == {"q": 2, "other": 0}
    assert rows(store.read(RAW, "events").select("id", "v")) == [(i, "b" if i < 5 else "c" if i == 7 else "a") for i in range(10)]


def test_the_newest_commit_is_found_without_the_others(spark, store, monkeypatch):
    for hours in range(6):
        store.upsert(RAW, SPEC, batch(spark, [1], str(hours), hours))
    for old in range(5):  # only that they are there is asked
        for file in Path(store.root, "raw", "events", "commits", f"c={old}").glob("*.parquet"):
            file.unlink()
    assert store.commit(RAW, "events").generation == 5
    (Path(store.root) / "raw/events/commits/c=6").mkdir()  # an attempt that died
    assert store.commit(RAW, "events").generation == 5
    assert store.upsert(RAW, SPEC, batch(spark, [1], "again", 9)) == 1 and store.commit(RAW, "events").generation == 6
