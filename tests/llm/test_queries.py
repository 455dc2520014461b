"""Registered queries against their SQL, and the pipeline against its stages run by hand."""

from __future__ import annotations

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from dimflow.llm.common import REGISTRY, prepare, table
from tests.compare import difference, duck
from tests.conftest import plan

SF_DIR = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if n in oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, duck(SF_DIR), name, SF_DIR) is None


@pytest.mark.parametrize("name", ["op2_quality_rules", "op3_decontamination", "op10_url_filter"])
def test_native_queries_run_no_python(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))


def test_pipeline_keeps_what_every_stage_keeps(spark):
    docs = table(prepare(spark), SF_DIR, "documents")
    ids = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").collect()}
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR)
        assert after.columns == docs.columns
        kept = spark.createDataFrame(after.collect(), docs.schema)
    assert ids == {r.doc_id for r in kept.select("doc_id").collect()} and 0 < len(ids) < docs.count()
