"""Every registered query against its SQL, and the plans Spark makes of them."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from dimflow.oracles import ORACLES
from dimflow.queries import REGISTRY
from tests.compare import difference, duck
from tests.conftest import plan

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(REGISTRY) and set(ORACLES) <= set(oracle_sql()) and set(REGISTRY) <= set(queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_flagship_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["pit_join", "fact_transactions", "upsert_single_key", "effective_dated_lookup",
                                  "batch_trace", "mass_balance", "duplicate_candidates", "recon_report"])
def test_no_query_pairs_rows_without_a_key(spark, name):
    """With nothing small enough to broadcast, every join is an equi-join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries()[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries()["highwater_batch"](spark, SF_DIR).select("event_id"))
    assert "GreaterThan(ts,2024-01-15T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    text = plan(queries()["pit_join"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "customer_key:bigint,code:string" in text and "c_mktsegment" not in text.split("Scan parquet")[-1]
