from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.operators.surrogate import dense_keys, last_key
from tests.conftest import plan, rows


def test_keys_follow_the_order_across_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("id"), F.lit("x").alias("v"))
        keyed = dense_keys(df, "k", ["id"])
        assert keyed.where(F.col("k") != F.col("id") + 1).count() == 0
        assert keyed.count() == 5000
        assert keyed.columns == ["k", "id", "v"]
        backwards = dense_keys(df, "k", [F.col("id").desc()])
        assert backwards.where(F.col("k") != 5000 - F.col("id")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_keys_stay_dense_when_a_third_of_the_rows_share_the_leading_column(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), "id")
    keyed = dense_keys(df, "k", ["g", "id"])
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 3001))


def test_keys_continue_after_those_in_use(spark):
    used = spark.createDataFrame([(3,), (7,)], "k bigint")
    more = spark.createDataFrame([("b",), ("a",)], "v string")
    assert rows(dense_keys(more, "k", ["v"], last_key(used, "k"))) == [(8, "a"), (9, "b")]
    assert last_key(used.where("k > 99"), "k") == 0


def test_no_rows_no_keys(spark):
    assert rows(dense_keys(spark.createDataFrame([], "v string"), "k", ["v"])) == []


def test_numbered_rows_are_a_projection_of_what_was_written(spark):
    text = plan(dense_keys(spark.range(100), "k", ["id"]))
    assert "Scan parquet" in text
    assert not any(step in text for step in ("Exchange", "Window", "Join", "Sort"))
