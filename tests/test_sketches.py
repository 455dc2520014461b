"""Kept sketches and hot values against exact counts."""

from __future__ import annotations

import pytest

from dimflow.plans import sketches
from dimflow.plans.hotkeys import hot_key_advice, hot_values
from dimflow.plans.layout import Usage, distribution, key_cardinality
from dimflow.registry import TableSpec
from dimflow.sources.store import RAW

SPEC = TableSpec("t", ("id",), incremental=True, id_range=1000)


def batch(spark, start, n):
    return spark.range(start, start + n).selectExpr("id", "id % 700 as k", "repeat('x', cast(id % 9 as int)) as s", "timestamp_ntz'2026-01-01' as updated_at")


def test_only_new_directories_are_read_and_the_merge_is_near(spark, store, monkeypatch):
    read = []
    monkeypatch.setattr(store, "read_places", lambda *a, make=store.read_places: read.append(a[2]) or make(*a))
    store.upsert(RAW, SPEC, batch(spark, 0, 5000))
    assert sketches.refresh(store, RAW, "t", ("k", "id")) == 5
    store.upsert(RAW, SPEC, batch(spark, 4990, 2000))
    assert sketches.refresh(store, RAW, "t", ("k", "id")) == 3  # one rewritten, two new
    assert read[1] == ["gen=1/_b=4", "gen=1/_b=5", "gen=1/_b=6"]
    assert sketches.refresh(store, RAW, "t", ("k", "id")) == 0 and len(read) == 2
    stats = sketches.kept_stats(store, RAW, "t", ("k", "id"))
    got = {r.column_name: r for r in key_cardinality(stats).collect()}
    assert {r.row_count for r in got.values()} == {6990}
    assert abs(got["k"].distinct_count - 700) < 28 and abs(got["id"].distinct_count - 6990) < 280
    assert stats.first().lengths == {"s": 8} and distribution(stats).first().distkey == "id"
    assert sketches.refresh(store, RAW, "t", ("k",)) == 7  # other keys: all anew


def test_hot_values_are_counted_exactly(spark):
    df = spark.range(1000).selectExpr("case when id % 4 = 0 then 'hot' when id % 5 = 0 then null when id = 1 then '' else string(id) end as k", "id", "id % 3 as m")
    got = {(r.column_name, r.value): (r.n_rows, round(r.share, 3)) for r in hot_values(df, "t", ("k", "id", "m")).collect()}
    assert got == {("k", "hot"): (250, 0.25), ("k", None): (150, 0.15), ("m", "0"): (334, 0.334), ("m", "1"): (333, 0.333), ("m", "2"): (333, 0.333)}
    assert hot_values(df.limit(0), "t", ("k",)).count() == 0
    with pytest.raises(ValueError, match="larger sketch"):
        hot_values(df, "t", ("k",), share=0.001)


def test_a_key_of_many_values_with_a_hot_one_is_not_safe(spark):
    fact = spark.range(20_000).selectExpr("if(id % 3 = 0, -1, id) as buyer", "id as sale", "id % 2 as flag")
    usages = {"bad": Usage(("buyer",)), "good": Usage(("sale",)), "even": Usage(("flag",)), "none": Usage()}
    advice = {r.table_name: r for r in hot_key_advice(dict.fromkeys(usages, fact), usages).collect()}
    assert (advice["bad"].distkey, advice["bad"].safe, advice["bad"].hot_value, advice["bad"].hot_rows) == ("buyer", False, "-1", 6667)
    assert advice["bad"].hot_action == "salt buyer before shuffles"
    assert (advice["good"].safe, advice["good"].hot_value) == (True, None)
    assert (advice["even"].distkey, advice["even"].safe, advice["none"].safe) == (None, None, None)
    assert hot_key_advice({"none": fact}, usages).columns == list(advice["bad"].asDict())
