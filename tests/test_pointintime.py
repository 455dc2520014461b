from __future__ import annotations

import random
from datetime import datetime, timedelta

from dimflow.operators import pointintime
from tests.conftest import plan, rows

DIM = "x_key bigint, code string, valid_from timestamp_ntz, valid_to timestamp_ntz"
FACT = "tx_id int, code int, tx_date timestamp_ntz"
START, END = datetime(1900, 1, 1), datetime(9999, 12, 31)


def versions(spark, data):
    return spark.createDataFrame(data, DIM)


def test_fact_gets_the_version_valid_at_its_date(spark):
    change = datetime(2026, 6, 1)
    dim = versions(spark, [(1, "700001", START, change), (2, "700001", change, END)])
    facts = spark.createDataFrame(
        [
            (1, 700001, datetime(2026, 1, 15)),
            (2, 700001, datetime(2026, 7, 1)),
            (3, 700001, change),
            (4, 1, datetime(2026, 7, 1)),
            (5, None, datetime(2026, 7, 1)),
            (6, 700001, None),
        ],
        FACT,
    )
    for resolve in (pointintime.resolve, pointintime.resolve_deep):
        found = resolve(facts, dim, "x_key", "code", "code", "tx_date")
        assert found.columns == ["tx_id", "code", "tx_date", "x_key"]
        assert rows(found.select("tx_id", "x_key")) == [(1, 1), (2, 2), (3, 2), (4, None), (5, None), (6, None)]


def history(seed):
    """Keys with 1 to 200 versions, and facts of which a third fall on one key."""
    rng = random.Random(seed)
    dim, key = [], 0
    for code, depth in (("hot", 200), ("one", 1), ("some", 12), ("late", 3)):
        changes = sorted({datetime(2020, 1, 1) + timedelta(hours=rng.randrange(40_000)) for _ in range(depth - 1)})
        bounds = [datetime(2021, 1, 1) if code == "late" else START, *changes, END]
        if code == "late":
            bounds = sorted(bounds)
        for lo, hi in zip(bounds, bounds[1:]):
            key += 1
            dim.append((key, code, lo, hi))
    facts = [
        (i, "hot" if i % 3 == 0 else rng.choice(["one", "some", "late", "none"]),
         datetime(2019, 6, 1) + timedelta(minutes=rng.randrange(3_000_000)))
        for i in range(1500)
    ]
    facts += [(2000 + i, code, lo) for i, (_, code, lo, _) in enumerate(dim) if lo != START]
    return dim, facts


def test_deep_histories_match_brute_force(spark):
    dim, facts = history(7)
    want = sorted(
        (i, next((k for k, c, lo, hi in dim if c == code and lo <= at < hi), None)) for i, code, at in facts
    )
    fact_df = spark.createDataFrame(facts, "tx_id int, code string, tx_date timestamp_ntz")
    dim_df = versions(spark, dim)
    plain = pointintime.resolve(fact_df, dim_df, "x_key", "code", "code", "tx_date")
    assert rows(plain.select("tx_id", "x_key")) == want
    for deep, cell in ((0, "day"), (10, "month"), (64, "week"), (1000, "year")):
        found = pointintime.resolve_deep(
            fact_df, dim_df, "x_key", "code", "code", "tx_date", deep=deep, cell=cell
        )
        assert rows(found.select("tx_id", "x_key")) == want


def test_same_typed_keys_are_compared_without_a_cast(spark):
    dim = spark.createDataFrame([(1, 5, START, END)], DIM.replace("code string", "code int"))
    facts = spark.createDataFrame([(1, 5, datetime(2026, 1, 1))], FACT)
    found = pointintime.resolve(facts, dim, "x_key", "code", "code", "tx_date")
    assert "cast(code" not in plan(found)
    assert found.first().x_key == 1


def test_entity_versions_joins_ids_to_versions_of_their_code(spark):
    entity = spark.createDataFrame([(10, 7), (11, 8)], "id int, code int")
    dim = versions(spark, [(1, "7", START, END)])
    found = pointintime.entity_versions(entity, dim, "id", "x_key", "code")
    assert rows(found) == [(10, 1, START, END)]


def test_coverage_counts_facts_and_hits(spark):
    resolved = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "g string, k int")
    assert rows(pointintime.coverage(resolved, "k", ["g"])) == [("a", 2, 1), ("b", 1, 1)]


def test_hot_key_is_split_in_a_shuffled_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(600_000).selectExpr(
            "id as tx_id",
            "cast(if(id % 3 = 0, 0, pmod(xxhash64(id), 5000)) as string) as code",
            "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, id) as tx_date",
        )
        half = "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, 300000)"
        dim = spark.range(10_000).selectExpr(
            "id as x_key",
            "cast(id div 2 as string) as code",
            f"if(id % 2 = 0, timestamp_ntz'1900-01-01', {half}) as valid_from",
            f"if(id % 2 = 0, {half}, timestamp_ntz'9999-12-31') as valid_to",
        )
        found = pointintime.resolve(facts, dim, "x_key", "code", "code", "tx_date")
        # The fact ids take part, so that the whole row is shuffled.
        total = found.selectExpr(
            "count(*) as n", "sum(tx_id) as ids",
            "count_if(x_key = 2 * cast(code as bigint) + if(tx_id >= 300000, 1, 0)) as right",
        )
        assert tuple(total.first()) == (600_000, 599_999 * 300_000, 600_000)
        total.collect()
        assert "skew=true" in plan(total)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
