from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from dimflow.operators import trace
from tests.conftest import rows

TX = "tx int, node int, at timestamp_ntz, kg decimal(10,2), farmer string"
EV = "event_id int, batch_id string, ts timestamp_ntz, kind string, kg decimal(10,2)"
MON, SUN, NEXT = datetime(2025, 12, 29), datetime(2026, 1, 4, 23, 59), datetime(2026, 1, 5)
WEEK1, WEEK2 = "BATCH-7-2025-12-29/2026-01-04", "BATCH-7-2026-01-05/2026-01-11"


def data(spark):
    tx = [
        (1, 7, MON, Decimal("1.10"), "a"),
        (2, 7, SUN, Decimal("2.20"), "b"),
        (3, 7, NEXT, Decimal("5.00"), "a"),
    ]
    events = [
        (1, WEEK1, MON, "collected", Decimal("3.30")),
        (2, WEEK1, NEXT, "exported", Decimal("3.30")),
        (3, WEEK1, NEXT, "checked", Decimal("3.30")),
        (4, "BATCH-9-unknown", NEXT, "collected", Decimal("1.00")),
    ]
    return spark.createDataFrame(tx, TX), spark.createDataFrame(events, EV)


def test_weeks_run_from_monday_to_sunday_across_the_year(spark):
    tx, _ = data(spark)
    assert rows(trace.assemble(tx, "node", "at", "kg")) == [
        (WEEK1, 7, Decimal("3.30"), SUN),
        (WEEK2, 7, Decimal("5.00"), NEXT),
    ]


def test_every_transaction_is_linked_to_its_batch(spark):
    tx, _ = data(spark)
    assert rows(trace.links(tx, "node", "at", "kg", "tx").select("batch_id", "transaction_id")) == [
        (WEEK1, 1), (WEEK1, 2), (WEEK2, 3),
    ]


def test_trace_names_the_lots_and_the_last_event(spark):
    tx, events = data(spark)
    links = trace.links(tx, "node", "at", "kg", "tx")
    found = trace.trace(links, tx.select("tx", "farmer"), "tx", events.drop("kg"), "ts", "event_id")
    assert rows(found.select("transaction_id", "farmer", "kind", "traced")) == [
        (1, "a", "checked", True), (2, "b", "checked", True), (3, "a", None, False),
    ]


def test_balance_needs_both_sides_to_agree(spark):
    tx, events = data(spark)
    links = trace.links(tx, "node", "at", "kg", "tx")
    found = trace.mass_balance(links, events, "kg")
    assert rows(found.select("batch_id", "n_lots", "n_events", "balanced")) == [
        (WEEK1, 2, 3, True), (WEEK2, 1, 0, False), ("BATCH-9-unknown", 0, 1, False),
    ]
    short = events.withColumn("kg", events.kg - (events.event_id == 2).cast("int"))
    assert not trace.mass_balance(links, short, "kg").where(f"batch_id = '{WEEK1}'").first().balanced
