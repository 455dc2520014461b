from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from dimflow.operators.highwater import high_water, past_mark
from dimflow.operators.upsert import keyed_upsert, latest_per_key
from tests.conftest import plan, rows

SCHEMA = "id int, part int, v string, updated_at timestamp_ntz"
D1, D2, D3 = (datetime(2026, 1, d) for d in (1, 2, 3))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_matching_keys_are_replaced_others_kept_and_added(spark):
    base = frame(spark, (1, 1, "a", D1), (1, 2, "b", D1), (2, 1, "c", D1))
    batch = frame(spark, (1, 2, "B", D2), (3, 1, "d", D2))
    once = keyed_upsert(base, batch, ["id", "part"], "updated_at")
    want = [(1, 1, "a", D1), (1, 2, "B", D2), (2, 1, "c", D1), (3, 1, "d", D2)]
    assert rows(once) == want
    assert rows(keyed_upsert(once, batch, ["id", "part"], "updated_at")) == want


def test_latest_copy_of_a_key_wins(spark):
    batch = frame(spark, *[(1, 1, f"v{i}", D1) for i in range(50)], (1, 1, "last", D3), (2, 1, "x", None))
    assert rows(latest_per_key(batch, ["id", "part"], "updated_at")) == [(1, 1, "last", D3), (2, 1, "x", None)]


def test_copies_of_a_key_shrink_before_the_shuffle(spark):
    text = plan(latest_per_key(frame(spark, (1, 1, "a", D1)), ["id", "part"], "updated_at"))
    assert text.index("partial_max") < text.index("hashpartitioning")


def test_null_key_is_refused(spark):
    with pytest.raises(PySparkException, match="NULL in key column part"):
        latest_per_key(frame(spark, (1, None, "a", D1)), ["id", "part"], "updated_at").collect()


def test_other_columns_are_refused(spark):
    base = frame(spark, (1, 1, "a", D1))
    with pytest.raises(ValueError, match="missing \\['v'\\]"):
        keyed_upsert(base, base.drop("v"), ["id"], "updated_at")
    with pytest.raises(ValueError, match="retyped \\['part'\\]"):
        keyed_upsert(base, base.withColumn("part", base.part.cast("bigint")), ["id"], "updated_at")


def test_mark_is_strict_unless_asked_otherwise(spark):
    df = frame(spark, (1, 1, "a", D1), (2, 1, "b", D2), (3, 1, "c", D3), (4, 1, "d", None))
    ids = lambda d: [r[0] for r in rows(d.select("id"))]
    assert ids(past_mark(df, "2026-01-02 00:00:00")) == [3]
    assert ids(past_mark(df, "2026-01-02 00:00:00", inclusive=True)) == [2, 3]
    assert ids(past_mark(df, "2026-01-01 00:00:00", cap_at="2026-01-02 00:00:00")) == [2]
    assert ids(past_mark(df)) == [1, 2, 3]
    assert high_water(df).first().last_watermark == D3
    assert high_water(df.where("id > 9")).first().last_watermark is None


def test_mark_and_columns_reach_the_scan(spark, tmp_path):
    frame(spark, (1, 1, "a", D1)).write.parquet(str(tmp_path / "t"))
    text = plan(past_mark(spark.read.parquet(str(tmp_path / "t")), "2026-01-02 00:00:00").select("id", "updated_at"))
    assert "GreaterThan(updated_at,2026-01-02T00:00)" in text
    assert "ReadSchema: struct<id:int,updated_at:timestamp_ntz>" in text
