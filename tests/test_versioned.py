from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimflow.operators import versioned
from dimflow.session import materialise
from tests.conftest import rows

INCEPTION, FUTURE = datetime(1900, 1, 1), datetime(9999, 12, 31)
AS_OF = "2026-06-01 00:00:00"


def snapshot(spark, data, schema="code string, region int"):
    return spark.createDataFrame(data, schema)


def apply(dim, incoming, as_of=AS_OF, tracked=("region",)):
    return versioned.apply_snapshot(dim, incoming, "x_key", "code", list(tracked), as_of)


def counts(wave):
    return tuple(wave.summary().first())


def test_first_build_is_valid_from_inception_not_from_the_run(spark):
    wave = apply(None, snapshot(spark, [("a", 1), ("b", 2)]))
    assert counts(wave) == (2, 0)
    assert rows(wave.dim) == [
        (1, "a", 1, INCEPTION, FUTURE, True),
        (2, "b", 2, INCEPTION, FUTURE, True),
    ]


def test_unchanged_snapshot_is_a_no_op(spark):
    first = apply(None, snapshot(spark, [("a", 1)]))
    again = apply(first.dim, snapshot(spark, [("a", 1)]))
    assert counts(again) == (0, 0)
    assert rows(again.dim) == rows(first.dim)


def test_change_closes_the_old_version_and_opens_a_new_one(spark):
    first = apply(None, snapshot(spark, [("a", 1), ("b", 1)]))
    wave = apply(first.dim, snapshot(spark, [("a", 2), ("b", 1)]))
    at = datetime(2026, 6, 1)
    assert counts(wave) == (1, 1)
    assert rows(wave.dim) == [
        (1, "a", 1, INCEPTION, at, False),
        (2, "b", 1, INCEPTION, FUTURE, True),
        (3, "a", 2, at, FUTURE, True),
    ]


def test_new_keys_start_at_inception_and_are_numbered_before_changes(spark):
    first = apply(None, snapshot(spark, [("b", 1), ("c", 1)]))
    wave = apply(first.dim, snapshot(spark, [("a", 9), ("b", 2), ("z", 9)]))
    new = rows(wave.versions.select("x_key", "code", "valid_from", "change"))
    assert new == [
        (3, "a", INCEPTION, "new"),
        (4, "z", INCEPTION, "new"),
        (5, "b", datetime(2026, 6, 1), "changed"),
    ]


def test_key_missing_from_the_snapshot_stays_current(spark):
    first = apply(None, snapshot(spark, [("a", 1), ("b", 1)]))
    wave = apply(first.dim, snapshot(spark, [("a", 1)]))
    assert rows(wave.dim) == rows(first.dim)


def test_untracked_columns_do_not_make_a_version(spark):
    schema = "code string, region int, name string"
    first = apply(None, snapshot(spark, [("a", 1, "old")], schema))
    wave = apply(first.dim, snapshot(spark, [("a", 1, "new")], schema))
    assert rows(wave.dim.select("name")) == [("old",)]


def test_numeric_key_equals_the_same_key_in_text(spark):
    first = apply(None, snapshot(spark, [(700001, 1)], "code int, region int"))
    wave = apply(first.dim, snapshot(spark, [("700001", 1)]))
    assert counts(wave) == (0, 0)
    assert first.dim.schema["code"].dataType.simpleString() == "string"


def test_tracked_value_in_another_type_is_no_change(spark):
    first = apply(None, snapshot(spark, [("a", 1)]))
    wave = apply(first.dim, snapshot(spark, [("a", 1)], "code string, region bigint"))
    assert counts(wave) == (0, 0)


def test_nulls_are_equal_and_differ_from_values(spark):
    first = apply(None, snapshot(spark, [("a", None), ("b", None), ("c", 1)]))
    wave = apply(first.dim, snapshot(spark, [("a", None), ("b", 2), ("c", None)]))
    assert rows(wave.versions.select("code")) == [("b",), ("c",)]


def test_null_natural_key_is_refused(spark):
    from pyspark.errors import PySparkException

    try:
        apply(None, snapshot(spark, [(None, 1)])).dim.collect()
    except PySparkException as error:
        assert "NULL in key column code" in str(error)
    else:
        raise AssertionError("a NULL key went through")


def test_snapshot_of_another_shape_is_refused(spark):
    first = apply(None, snapshot(spark, [("a", 1)]))
    try:
        apply(first.dim, snapshot(spark, [("a", 1, 2)], "code string, region int, extra int"))
    except ValueError as error:
        assert "extra" in str(error)
    else:
        raise AssertionError("an extra column went through")


def test_many_waves_leave_intervals_without_gap_or_overlap(spark):
    dim = None
    for wave_number in range(4):
        # Key i changes in every wave that divides by its number.
        data = [(f"k{i:03d}", wave_number // (1 + i % 3)) for i in range(60)]
        dim = apply(dim, snapshot(spark, data), f"2026-0{wave_number + 1}-01 00:00:00").dim
    by_key = Window.partitionBy("code").orderBy("valid_from")
    breaks = dim.withColumn("next", F.lead("valid_from").over(by_key)).where(F.col("next") != F.col("valid_to"))
    assert breaks.count() == 0
    per_key = dim.groupBy("code").agg(F.count_if("is_current").alias("n"), F.max("valid_to").alias("last"))
    assert rows(per_key.select("n", "last").distinct()) == [(1, FUTURE)]
    keys = [r.x_key for r in dim.select("x_key").orderBy("x_key").collect()]
    assert keys == list(range(1, len(keys) + 1))
    versions = dict(rows(versioned.multi_version_keys(dim, "code")))
    assert versions["k000"] == 4 and versions["k001"] == 2


def model(dim, incoming, as_of):
    """One wave in plain Python: rows are [key, code, region, from, to, current]."""
    current = {row[1]: row for row in dim if row[5]}
    last = max((row[0] for row in dim), default=0)
    new = sorted(code for code in incoming if code not in current)
    changed = sorted(code for code, region in incoming.items() if code in current and current[code][2] != region)
    for code in changed:
        current[code][4:] = [as_of, False]
    added = [(code, INCEPTION) for code in new] + [(code, as_of) for code in changed]
    return dim + [
        [last + i, code, incoming[code], start, FUTURE, True] for i, (code, start) in enumerate(added, start=1)
    ]


def test_random_waves_match_a_plain_model(spark):
    rng = random.Random(11)
    dim, want = None, []
    for wave in range(4):
        as_of = datetime(2026, 1 + wave, 1)
        codes = rng.sample(range(40), 25)
        incoming = {f"c{i:02d}": rng.choice([None, 1, 2]) for i in codes}
        want = model(want, incoming, as_of)
        result = apply(dim, snapshot(spark, list(incoming.items())), as_of.strftime("%Y-%m-%d %H:%M:%S"))
        dim = materialise(result.dim, "wave")
        assert rows(dim) == sorted(tuple(r) for r in want)


def test_backward_or_repeated_snapshots_are_errors(spark):
    def snapshot(*values):
        return spark.createDataFrame(list(values), "code string, v string")

    first = versioned.initial_load(snapshot(("a", "x")), "sk", "code").dim
    later = versioned.apply_snapshot(first, snapshot(("a", "y")), "sk", "code", ["v"], "2026-06-01")
    with pytest.raises(Exception, match="not later"):
        versioned.apply_snapshot(later.dim, snapshot(("a", "z")), "sk", "code", ["v"], "2026-01-01").dim.collect()
    with pytest.raises(ValueError, match="more than once"):
        versioned.apply_snapshot(first, snapshot(("b", "1"), ("b", "2")), "sk", "code", ["v"], "2026-06-01")
