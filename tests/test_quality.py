from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.operators.quality import duplicate_candidates, duplicate_members, review_order
from tests.conftest import rows

SCHEMA = "farmer_id int, farmer_code string, national_id string"


def test_shared_identity_is_flagged_with_its_members(spark):
    df = spark.createDataFrame([(1, "700002", "X"), (2, "700001", "X"), (3, "700003", "Y"), (4, "7", None),
                                (5, "8", None)], SCHEMA)
    found = duplicate_candidates(df, "national_id", "national_id")
    assert rows(found) == [("X", 2)]


def test_distinct_identities_are_not_flagged(spark):
    df = spark.createDataFrame([(1, "700001", "X"), (2, "700002", "Y")], SCHEMA)
    assert rows(duplicate_candidates(df, "national_id", "national_id")) == []


def test_groups_of_any_size_have_one_shape(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 700).cast("string")).alias("g"), "id"
    )
    assert [r for r in rows(duplicate_candidates(df, "g", "g")) if r[0] == "hot"] == [("hot", 1000)]
    hot = [int(r.member) for r in duplicate_members(df, "g", "g", "id").collect() if r.g == "hot"]
    assert sorted(hot) == list(range(0, 3000, 3))


def test_members_come_one_per_row(spark):
    df = spark.createDataFrame([(1, "b", "X"), (2, "a", "X"), (3, "c", "Y")], SCHEMA)
    assert rows(duplicate_members(df, "national_id", "id", "farmer_code")) == [("X", 2, "a"), ("X", 2, "b")]


def test_most_frequent_identity_is_reviewed_first(spark):
    df = spark.createDataFrame([(i, str(i), x) for i, x in enumerate("aabbbcc")], SCHEMA)
    found = review_order(duplicate_candidates(df, "national_id", "id"), "id")
    assert [r.id for r in found.collect()] == ["b", "a", "c"]
