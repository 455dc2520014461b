from __future__ import annotations

import hashlib
import re
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from dimflow.functions.rowhash import digest_halves
from dimflow.operators.reconcile import Pair, all_passed, compare, fingerprint, report
from tests.conftest import plan

SCHEMA = "id int, value string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def passed(checks):
    return {(r.table_name, r.check_type): r.passed for r in checks.collect()}


def test_same_rows_in_another_order_agree(spark):
    a = frame(spark, (1, "a"), (2, "b"), (3, None))
    b = frame(spark, (3, None), (1, "a"), (2, "b")).select("value", "id")
    checks = compare([Pair("t", a, b)])
    assert passed(checks) == {("t", "row_count"): True, ("t", "row_hash"): True}
    assert all_passed(checks).first().all_passed


def test_missing_row_fails_both_checks(spark):
    checks = compare([Pair("t", frame(spark, (1, "a"), (2, "b"), (3, "c")), frame(spark, (1, "a"), (2, "b")))])
    assert passed(checks) == {("t", "row_count"): False, ("t", "row_hash"): False}
    assert not all_passed(checks).first().all_passed


def test_silent_change_fails_only_the_hash(spark):
    checks = compare([Pair("t", frame(spark, (1, "a"), (2, "b")), frame(spark, (1, "a"), (2, "B")))])
    assert passed(checks) == {("t", "row_count"): True, ("t", "row_hash"): False}


def test_hash_is_the_low_64_bits_of_sha256_folded(spark):
    data = [(1, "a|b"), (2, None), (3, "ü")]
    want = 0
    for i, v in data:
        want ^= int(hashlib.sha256(f"{i}|{v or ''}".encode()).hexdigest(), 16) & (1 << 64) - 1
    assert fingerprint(frame(spark, *data)).first() == (3, str(want))


def test_values_are_hashed_as_canonical_text(spark):
    df = spark.createDataFrame(
        [(Decimal("1.50"), datetime(2026, 1, 2, 3, 4, 5, 6), True, [1, 2])],
        "d decimal(10,2), t timestamp_ntz, b boolean, a array<int>",
    )
    text = '1.50|2026-01-02 03:04:05.000006|true|{"a":[1,2]}'
    want = int(hashlib.sha256(text.encode()).hexdigest(), 16) & (1 << 64) - 1
    assert fingerprint(df).first().row_hash == str(want)


def test_a_digest_is_read_as_a_number_once(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("text"))
    low = [int(hashlib.sha256(str(i).encode()).hexdigest(), 16) & (1 << 64) - 1 for i in range(200)]
    halves = digest_halves(F.col("text"))
    assert [tuple(r) for r in df.select(*halves).collect()] == [(n >> 32, n & 0xFFFFFFFF) for n in low]
    assert len({m for half in halves for m in re.findall(r"conv\(.*?, 16, -?10\)", str(half))}) == 1


def test_empty_table_hashes_to_zero(spark):
    assert fingerprint(frame(spark, (1, "a")).where("id > 1")).first() == (0, "0")


def test_strict_hash_sees_what_the_default_cannot(spark):
    twice, none = frame(spark, (1, "a"), (1, "a")), frame(spark, (2, "b"), (2, "b"))
    null, empty = frame(spark, (1, None)), frame(spark, (1, ""))
    split = spark.createDataFrame([("a|b", "c")], "x string, y string")
    other = spark.createDataFrame([("a", "b|c")], "x string, y string")
    for a, b in ((twice, none), (null, empty), (split, other)):
        assert fingerprint(a).first() == fingerprint(b).first()
        assert fingerprint(a, strict=True).first() != fingerprint(b, strict=True).first()


def test_report_has_the_columns_the_audit_keeps(spark):
    a = frame(spark, (1, "a"))
    found = report([Pair("t", a, a), Pair("u", a, a)], "run")
    assert found.columns == [
        "run_id", "table_name", "check_type", "source_value", "target_value", "passed", "checked_at",
    ]
    assert found.count() == 4 and found.where("checked_at is not null and run_id = 'run'").count() == 4


def test_tables_are_reduced_to_a_row_before_they_meet(spark):
    big = spark.range(1000).select("id", F.lit("x").alias("v"))
    text = plan(compare([Pair("t", big, big)]))
    assert "Join" not in text and "Cartesian" not in text
    assert "partial_bit_xor" in text
