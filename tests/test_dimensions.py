from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from dimflow.operators import dimensions
from tests.conftest import rows


def test_calendar_across_a_year_end(spark):
    a = spark.createDataFrame([(datetime(2025, 12, 31, 23, 0),)], "d timestamp_ntz")
    b = spark.createDataFrame([(datetime(2026, 1, 2, 1, 0),), (None,)], "e timestamp_ntz")
    found = dimensions.date_dimension([F.col("d"), F.col("e")], [a, b])
    assert rows(found) == [
        (20251231, date(2025, 12, 31), 3, 12, 4, 2025),
        (20260101, date(2026, 1, 1), 4, 1, 1, 2026),
        (20260102, date(2026, 1, 2), 5, 1, 1, 2026),
    ]


def test_calendar_of_nothing_is_empty(spark):
    empty = spark.createDataFrame([], "d timestamp_ntz")
    assert rows(dimensions.date_dimension([F.col("d")], [empty])) == []


def test_current_state_puts_a_dense_key_in_front(spark):
    df = spark.createDataFrame([(30, "c"), (10, "a"), (20, None)], "id int, name string")
    assert rows(dimensions.current_state(df, "k", ["id"])) == [(1, 10, "a"), (2, 20, None), (3, 30, "c")]


def test_effective_lookup_includes_both_bounds_and_keeps_misses(spark):
    certs = spark.createDataFrame(
        [("x", 1, date(2026, 1, 1), date(2026, 1, 31)), ("y", 1, date(2026, 1, 31), date(2026, 2, 28))],
        "cert string, plot int, issued date, expiry date",
    )
    facts = spark.createDataFrame(
        [(1, datetime(2025, 12, 31, 23)), (1, datetime(2026, 1, 1)), (1, datetime(2026, 1, 31, 23)), (2, None)],
        "plot_id int, at timestamp_ntz",
    )
    found = dimensions.effective_lookup(
        facts, certs, {"plot_id": "plot"}, "at", "issued", "expiry", {"cert": "certificate"}
    )
    assert [(r.at.day if r.at else None, r.certificate) for r in found.orderBy("at", "certificate").collect()] == [
        (None, None), (31, None), (1, "x"), (31, "x"), (31, "y"),
    ]
