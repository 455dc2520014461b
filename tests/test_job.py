from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dimflow import harvest, session
from dimflow.plans.definitions import create_tables
from dimflow.plans.job import plan_steps, run_job
from dimflow.sources.export import write_export
from dimflow.sources.store import ANALYTICS, RAW
from tests.conftest import rows

DAY = datetime(2026, 3, 2)
TABLES = {
    "regions": [(1, "north", "province", None), (2, "south", "district", 1)],
    "crop_types": [(1, "cocoa", "plantation", "kg"), (2, "vanilla", "spice", "kg")],
    "field_agents": [(1, "A1", "agent", 1, "field", date(2020, 1, 1), True)],
    "supply_chain_nodes": [(1, "collector", "c", 1, 1.0, 2.0), (2, "exporter", "e", 2, None, None)],
    "farmers": [
        (i, str(700000 + i), f"0{i}", f"name {i}", None if i == 3 else f"08{i}", 1, 1, DAY, DAY, True)
        for i in range(1, 6)
    ],
    "farm_plots": [
        (i, str(800000 + i), i, 1 + i % 2, 1, None, None, Decimal("1.25"), "owned", "none", DAY) for i in range(1, 6)
    ],
    "harvest_transactions": [
        (i, 1 + i % 5, 1 + i % 5, 1 + i % 2, 1, DAY + timedelta(hours=i), Decimal("10.50"), Decimal("2.00"),
         Decimal("21.00"), None, "A", "paid", DAY + timedelta(hours=i))
        for i in range(1, 21)
    ],
    "custody_events": [
        (1, "BATCH-1", None, None, 1, "collected", DAY, Decimal("210.00"), DAY),
        (2, "BATCH-1", 1, "collector", 2, "exported", DAY + timedelta(days=1), Decimal("210.00"), DAY),
    ],
    "batch_transactions": [("BATCH-1", i, Decimal("10.50"), DAY) for i in range(1, 21)],
    "certifications": [(1, 1, "body", "organic", "500001", date(2026, 1, 1), date(2027, 1, 1), "active", DAY)],
}


def source_of(spark, tables):
    return lambda name: spark.createDataFrame(tables[name], harvest.SCHEMAS[name])


def run(spark, store, tables=TABLES, **options):
    return run_job(store, source_of(spark, tables), harvest.TABLES, harvest.STAR, **options)


def counts(store):
    names = [d.name for d in (*harvest.STAR.versioned, *harvest.STAR.current)] + [f.name for f in harvest.STAR.facts]
    return {name: store.read(ANALYTICS, name).count() for name in [*names, "dim_date"]}


def second_wave():
    """Three farmers have moved, and sell again afterwards."""
    later = DAY + timedelta(days=30)
    moved = [(*f[:5], 2, *f[6:8], later, f[9]) if f[0] <= 3 else f for f in TABLES["farmers"]]
    more = [
        (100 + i, i, i, 1, 1, later + timedelta(hours=i), Decimal("1.00"), Decimal("2.00"), Decimal("2.00"), None,
         "B", "pending", later + timedelta(hours=i))
        for i in range(1, 6)
    ]
    return {**TABLES, "farmers": moved, "harvest_transactions": TABLES["harvest_transactions"] + more}, later


def test_a_job_leaves_no_intermediate_files(spark, store, monkeypatch):
    used = []
    monkeypatch.setattr(session, "fresh_path", lambda s, name, make=session.fresh_path: used.append(make(s, name)) or used[-1])
    kept = session.materialise(spark.range(3), "kept")
    for as_of in ("2026-03-10 00:00:00", "2026-03-11 00:00:00"):
        assert run(spark, store, as_of=as_of).ok
    assert kept.count() == 3 and len(used) > 3
    assert not [path for path in used[1:] if Path(path).exists()]
    assert not list(Path(session.shared_folder(spark), "dimflow").glob("run-*"))


def test_a_run_folder_is_one_for_all_its_threads_and_goes_with_an_error(spark):
    with pytest.raises(ZeroDivisionError), session.run_folder(spark) as folder:
        with session.run_folder(spark) as inner:
            assert inner == folder
        paths = session.side_by_side(spark, lambda n: session.fresh_path(spark, n), ["a", "b"])
        assert all(p.startswith(folder + "/") for p in paths)
        assert session.materialise(spark.range(2), "some").count() == 2
        assert Path(folder).exists()
        1 / 0
    assert not Path(folder).exists()
    assert "/run-" not in session.fresh_path(spark, "after")


def test_job_end_to_end_again_and_with_new_activity(spark, store):
    first = run(spark, store, as_of="2026-03-10 00:00:00", run_id="one")
    assert first.ok and first.statuses == {"extract": "SUCCESS", "transform": "SUCCESS", "validate": "SUCCESS"}
    built = counts(store)
    assert built == {
        "dim_farmer": 5, "dim_plot": 5, "dim_crop_type": 2, "dim_supply_chain_node": 2, "dim_location": 2,
        "dim_certification": 1, "fact_harvest_transactions": 20, "fact_custody_events": 2, "dim_date": 2,
    }
    fact = store.read(ANALYTICS, "fact_harvest_transactions")
    assert fact.where("farmer_key is null or plot_key is null or crop_type_key is null or node_key is null").count() == 0
    assert fact.columns == list(harvest.STAR.facts[0].columns)
    moves = store.read(ANALYTICS, "fact_custody_events")
    assert rows(moves.select("event_sk", "from_node_key", "to_node_key", "date_key")) == [
        (1, None, 1, 20260302), (2, 1, 2, 20260303),
    ]

    generation = store.commit(ANALYTICS, "dim_farmer").generation
    assert run(spark, store, as_of="2026-03-11 00:00:00", run_id="two").ok
    assert counts(store) == built
    assert store.commit(ANALYTICS, "dim_farmer").generation == generation

    tables, later = second_wave()
    as_of = later.strftime("%Y-%m-%d %H:%M:%S")
    assert run(spark, store, tables, as_of=as_of, run_id="three").ok
    dim = store.read(ANALYTICS, "dim_farmer")
    assert dim.count() == built["dim_farmer"] + 3
    assert dim.groupBy("farmer_code").count().where("count > 1").count() == 3
    resolved = (
        store.read(ANALYTICS, "fact_harvest_transactions")
        .join(dim, "farmer_key")
        .groupBy((F.col("transaction_date") >= later).alias("after"), "region_id")
        .count()
    )
    assert rows(resolved) == [(False, 1, 20), (True, 1, 2), (True, 2, 3)]

    steps = store.audit("pipeline_runs")
    assert steps.count() == 9 and steps.where("status = 'SUCCESS' and end_time >= start_time").count() == 9
    checks = store.audit("validation_results")
    assert checks.count() == 60 and checks.where("not passed").count() == 0

    named = {n: store.read(ANALYTICS, n) for n in harvest.USAGES}
    text = dict(rows(create_tables(named, harvest.USAGES)))
    assert len(text) == 8 and "\nDISTSTYLE ALL" in text["dim_farmer"]
    assert "quantity_kg DECIMAL(10,2)" in text["fact_harvest_transactions"]


def test_silent_change_in_the_source_makes_the_run_not_ok(spark, store):
    run(spark, store, steps=["extract"])
    tampered = {**TABLES, "farmers": [(*f[:3], "renamed", *f[4:]) for f in TABLES["farmers"]]}
    result = run(spark, store, tampered, steps=["extract", "validate"], run_id="check")
    assert not result.ok and result.statuses == {"extract": "SUCCESS", "validate": "SUCCESS"}
    failed = store.audit("validation_results").where("not passed")
    assert rows(failed.select("table_name", "check_type")) == [("farmers", "row_hash")]


def test_dry_run_only_logs(spark, store):
    assert run(spark, store, dry_run=True).ok
    assert not store.exists(RAW, "farmers")
    assert rows(store.audit("pipeline_runs").select("status").distinct()) == [("DRY_RUN",)]


def test_failed_extract_ends_the_run(spark, store):
    broken = {k: v for k, v in TABLES.items() if k != "farmers"}
    result = run(spark, store, broken, run_id="broken")
    assert not result.ok and result.statuses == {"extract": "FAILED"}
    row = store.audit("pipeline_runs").first()
    assert row.status == "FAILED" and "farmers" in row.error_message


def test_failed_transform_does_not_stop_the_checks(spark, store):
    run(spark, store, steps=["extract"])
    star = harvest.STAR.__class__((), (), (), calendar="dim_date")
    result = run_job(
        store, source_of(spark, TABLES), harvest.TABLES, star, steps=["transform", "validate"]
    )
    assert result.statuses == {"transform": "FAILED", "validate": "SUCCESS"} and not result.ok


def test_steps():
    assert [s.name for s in plan_steps()] == ["extract", "transform", "validate"]
    assert [s.name for s in plan_steps(["validate", "extract"])] == ["extract", "validate"]
    assert [s.name for s in plan_steps() if s.critical] == ["extract"]
    with pytest.raises(ValueError, match="no such step: load"):
        plan_steps(["load"])


def test_an_empty_source_table_gets_an_empty_raw_table_and_passes(spark, store):
    empty = {**TABLES, "custody_events": []}
    assert run(spark, store, empty, steps=["extract", "validate"]).ok
    assert store.read(RAW, "custody_events").count() == 0
    assert run(spark, store, steps=["extract", "validate"]).ok
    assert store.read(RAW, "custody_events").count() == 2


def test_a_table_never_loaded_fails_its_checks_only(spark, store):
    specs = [spec for spec in harvest.TABLES if spec.name in ("regions", "crop_types")]
    run_job(store, source_of(spark, TABLES), specs[:1], harvest.STAR, steps=["extract"])
    result = run_job(store, source_of(spark, TABLES), specs, harvest.STAR, steps=["validate"])
    assert result.statuses == {"validate": "SUCCESS"} and not result.ok
    checks = store.audit("validation_results")
    assert checks.count() == 4
    assert rows(checks.where("not passed").select("table_name").distinct()) == [(specs[1].name,)]


def test_export_reads_back_as_written(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "cast(id % 3 = 0 as int) as hot", "id % 7 as g", "id % 11 as h", "'x' as s")
    for usage in (
        harvest.USAGES["dim_date"],
        harvest.Usage(range_filter="hot"),
        harvest.Usage(equality_filters=("hot", "g", "h")),
    ):
        path = write_export(df, str(tmp_path), "t", usage)
        back = spark.read.schema(df.schema).parquet(path)
        assert back.columns == df.columns
        assert back.exceptAll(df).count() == 0 and back.count() == 2000


def test_export_spreads_a_hot_sort_value_over_tasks(spark):
    from dimflow.sources.export import laid_out

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 0, id) as d")
        sizes = laid_out(df, harvest.Usage(range_filter="d")).groupBy(F.spark_partition_id().alias("p")).count()
        assert max(r["count"] for r in sizes.collect()) < 1400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
