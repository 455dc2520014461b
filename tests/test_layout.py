from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dimflow.harvest import USAGES
from dimflow.plans.definitions import column_profile
from dimflow.plans.layout import Usage, gather, key_cardinality, layout_report, recommend, sort_advice
from tests.conftest import plan, rows


def advise(df, table, usages=USAGES):
    return recommend(df, table, usages).first()


def test_small_dimension_is_replicated(spark):
    rec = advise(spark.range(13).select(F.col("id").alias("season")), "dim_season", {"dim_season": Usage(("season",))})
    assert (rec.diststyle, rec.distkey, rec.row_count, rec.spark_action) == ("ALL", None, 13, "broadcast")
    assert rec.rationale == [
        "DISTSTYLE ALL: only 13 rows -- cheaper to replicate to every node than redistribute.",
        "No SORTKEY recommended -- no declared filter pattern for this table.",
    ]


SALES = {"fact_sales": Usage(join_keys=("customer", "item"), range_filter="day", equality_filters=("store",))}


def sales(spark, n, customer, item):
    exprs = [f"{customer} as customer", f"{item} as item", "cast(pmod(hash(id), 9) as int) as store", "id div 7 as day"]
    return spark.range(n).selectExpr(*exprs)


@pytest.mark.parametrize(("customer", "item", "key"), [("id div 3", "id div 5", "customer"), ("id div 5", "id div 3", "item")])
def test_the_key_with_most_values_distributes(spark, customer, item, key):
    rec = advise(sales(spark, 630, customer, item), "fact_sales", SALES)
    assert (rec.diststyle, rec.distkey, rec.spark_action) == ("KEY", key, f"partition by hash of {key}")
    assert rec.rationale[0].startswith(f"DISTKEY({key}): 33.3% cardinality (210/630)")


def test_of_equal_keys_the_first_declared_distributes(spark):
    assert advise(sales(spark, 420, "id div 2", "id div 2"), "fact_sales", SALES).distkey == "customer"


def test_keys_of_few_values_do_not_distribute(spark):
    rec = advise(sales(spark, 2500, "id div 500", "id div 2500"), "fact_sales", SALES)
    assert (rec.diststyle, rec.distkey) == ("EVEN", None)
    assert "0.2% cardinality" in rec.rationale[0]


@pytest.mark.parametrize("expression", ["id % 30", "cast(null as bigint)"])
def test_middling_or_empty_keys_are_spread_evenly(spark, expression):
    df = spark.range(1000).select(F.expr(expression).alias("k"))
    rec = advise(df, "fact", {"fact": Usage(("k",))})
    assert rec.diststyle == "EVEN"
    assert rec.rationale[0] == "DISTSTYLE EVEN: no join key clears the cardinality bar for a safe DISTKEY."


def test_empty_fact_and_empty_dimension(spark):
    empty = spark.range(0).select(F.col("id").alias("k"))
    assert advise(empty, "fact", {"fact": Usage(("k",))}).diststyle == "EVEN"
    assert advise(empty, "dim_k", {"dim_k": Usage(("k",))}).diststyle == "ALL"


def test_large_dimension_goes_by_its_key_and_small_fact_is_never_replicated(spark):
    usages = {"dim_big": Usage(("k",)), "fact_small": Usage(("k",))}
    big = spark.range(5001).select(F.col("id").alias("k"))
    assert advise(big, "dim_big", usages).diststyle == "KEY"
    assert advise(big.limit(3), "fact_small", usages).diststyle == "KEY"


def test_range_filter_leads_the_sort(spark):
    rec = advise(sales(spark, 70, "id", "id"), "fact_sales", SALES)
    assert (rec.sortkey_columns, rec.sortkey_type) == (["day", "store"], "COMPOUND")


def test_names_with_quotes_and_widths_in_bytes(spark):
    df = spark.sql("select 'é日' as `it's`, 1 as `a``b`")
    usages = {"o'table": Usage(join_keys=("a`b",))}
    assert rows(key_cardinality(gather({"o'table": df}, usages))) == [("o'table", "a`b", 1, 1, 1.0)]
    for in_bytes, width in ((False, 2 * 20), (True, 5 * 20)):
        wide = df.withColumn("it's", F.repeat(F.col("it's"), 10))
        assert column_profile(wide, "o'table", in_bytes).first() == ("o'table", 1, "it's", f"VARCHAR({width})")


def test_sort_rules():
    assert sort_advice(Usage(range_filter="d")).columns == ("d",)
    three = sort_advice(Usage(equality_filters=("a", "b", "c")))
    assert (three.columns, three.style) == (("a", "b", "c"), "INTERLEAVED")
    two = sort_advice(Usage(equality_filters=("a", "b")))
    assert (two.columns, two.style) == (("a", "b"), "COMPOUND")
    assert sort_advice(Usage(equality_filters=("a",))).columns == ("a",)
    assert sort_advice(Usage()).columns == ()


def test_unknown_table_is_an_error(spark):
    with pytest.raises(ValueError, match="no usage profile"):
        recommend(spark.range(1), "not_declared", USAGES)


def test_cardinality_ignores_nulls_and_can_be_estimated(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 10).alias("k"))
    stats = gather({"t": df}, {"t": Usage(("k",))})
    assert rows(key_cardinality(stats)) == [("t", "k", 1000, 5, 0.005)]
    approx = gather({"t": spark.range(10000).toDF("k")}, {"t": Usage(("k",))}, approx=True)
    assert abs(key_cardinality(approx).first().distinct_count - 10000) < 1500


def test_a_table_is_scanned_once(spark, tmp_path):
    spark.range(100).selectExpr("id as a", "id % 3 as b", "'x' as s", "'unused' as t").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(layout_report({"t": df}, {"t": Usage(("a", "b"))}))
    assert text.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "ReadSchema: struct<a:bigint,b:bigint>" in text
