from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from dimflow.operators.facts import CurrentRef, FactSpec, VersionedRef, build_fact, row_counts
from tests.conftest import plan, rows

START, CHANGE, END = datetime(1900, 1, 1), datetime(2026, 2, 1), datetime(9999, 12, 31)
SPEC = FactSpec(
    name="fact",
    source="tx",
    id_col="tx",
    sk_col="tx_sk",
    date_col="at",
    columns=("tx_sk", "buyer_key", "from_key", "to_key", "date_key", "kg"),
    versioned=(VersionedRef("dim_buyer", "buyer_key", "id", "buyer"),),
    current=(
        CurrentRef("dim_node", "node_key", "node", "source_node", "from_key"),
        CurrentRef("dim_node", "node_key", "node", "target_node", "to_key"),
    ),
)


def build(spark, spec=SPEC):
    tx = spark.createDataFrame(
        [
            (1, 10, None, 7, datetime(2026, 1, 31), 1.0, "unused"),
            (2, 10, 7, 8, datetime(2026, 2, 1), 2.0, "unused"),
            (3, 11, 9, 9, datetime(2026, 2, 1), 3.0, "unused"),
            (4, None, 7, 7, datetime(2026, 2, 1), 4.0, "unused"),
        ],
        "tx int, buyer int, source_node int, target_node int, at timestamp_ntz, kg double, note string",
    )
    buyers = spark.createDataFrame(
        [(10, 1, START, CHANGE), (10, 2, CHANGE, END)],
        "id int, buyer_key bigint, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    nodes = spark.createDataFrame([(1, 7), (2, 8)], "node_key bigint, node int")
    return build_fact(tx, spec, {"dim_buyer": buyers}, {"dim_node": nodes})


WANT = [
    (1, 1, None, 1, 20260131, 1.0),
    (2, 2, 1, 2, 20260201, 2.0),
    (3, None, None, None, 20260201, 3.0),
    (4, None, 1, 1, 20260201, 4.0),
]


def test_keys_are_resolved_and_no_row_is_lost(spark):
    fact = build(spark)
    assert fact.columns == list(SPEC.columns)
    assert rows(fact) == WANT


def test_deep_references_give_the_same_fact(spark):
    deep = replace(SPEC, versioned=(replace(SPEC.versioned[0], deep=1),))
    assert rows(build(spark, deep)) == WANT


def test_columns_that_are_not_kept_are_not_carried(spark):
    assert "note" not in plan(build(spark)).split("Project")[-1]


def test_row_counts_come_in_one_row(spark):
    found = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert found.columns == ["a_rows", "b_rows"] and tuple(found.first()) == (3, 0)


def test_small_dimensions_come_first_and_rows_move_once_for_each_id(spark):
    """What only a current dimension is looked up by does not move for the versioned ones, nor do rows that lie right already."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    try:
        lines = spark.range(20000).selectExpr("id as line", "id % 2000 as item", "id % 3000 as buyer", "timestamp_ntz'2026-01-01' as day")
        items = spark.range(2000).selectExpr("id as i", "concat('kind ', id % 3) as kind")
        spec = FactSpec(
            "f", "lines", "line", "sk", "day", ("sk", "item_key", "buyer_key", "kind_key"),
            versioned=(VersionedRef("items", "item_key", "id", "item"), VersionedRef("buyers", "buyer_key", "id", "buyer")),
            current=(CurrentRef("kinds", "kind_key", "name", "kind", "kind_key"),),
        )
        versions = {
            name: spark.range(3000).selectExpr(
                "id", f"id + 1 as {name[:-1]}_key", "timestamp_ntz'2025-01-01' as valid_from", "timestamp_ntz'2027-01-01' as valid_to")
            for name in ("items", "buyers")
        }
        kinds = spark.range(3).selectExpr("concat('kind ', id) as name", "id as kind_key")
        fact = build_fact(lines.join(items, lines.item == items.i, "left"), spec, versions, {"kinds": kinds})
        steps = plan(fact).split("\n\n")
        moves = [step for step in steps if "hashpartitioning(buyer" in step]
        assert len(moves) == 1 and "kind_key" in moves[0] and "kind#" not in moves[0]
        assert len([step for step in steps if "hashpartitioning(item#" in step]) == 1
        assert fact.where("item_key = line % 2000 + 1 and buyer_key = line % 3000 + 1".replace("line", "sk")).count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
