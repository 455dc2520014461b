"""Exports clustered by rank: files have narrow ranges of every sort column."""

from __future__ import annotations

import random
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from dimflow.plans.layout import Usage
from dimflow.sources.export import interleaved, write_export

SCHEMA = "skewed long, name string, day timestamp_ntz, flag string, other double"


@pytest.fixture
def many_files(spark):
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def table(spark, n=6000):
    rnd = random.Random(3)
    data = [
        (int(rnd.paretovariate(0.5)) % 10**9, "".join(rnd.choice("abcdefgh") for _ in range(9)), datetime(2020 + rnd.randint(0, 5), rnd.randint(1, 12), 1),
         rnd.choice("AB"), None if rnd.random() < 0.1 else rnd.random())
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, SCHEMA)


def test_a_filter_on_any_sort_column_reads_well_under_half_the_files(spark, tmp_path, many_files):
    data, df = table(spark)
    columns = ("skewed", "name", "day")
    path = write_export(df, str(tmp_path), "t", Usage(equality_filters=columns))
    files = [pq.ParquetFile(f).metadata for f in sorted(Path(path).glob("*.parquet"))]
    assert len(files) > 40 and sum(f.num_rows for f in files) == len(data)
    for i, column in enumerate(columns):
        values = sorted(row[i] for row in data)
        shares = []
        for q in (0.05, 0.3, 0.5, 0.7, 0.95):
            value = values[int(q * len(values))]
            met = 0
            for f in files:
                at = [f.row_group(0).column(c).path_in_schema for c in range(f.num_columns)].index(column)
                spans = [f.row_group(g).column(at).statistics for g in range(f.num_row_groups)]
                met += any(s.min <= value <= s.max for s in spans)
            shares.append(met / len(files))
        assert sum(shares) / len(shares) < 0.45, (column, shares)


def test_places_of_nulls_equal_values_and_many_columns(spark):
    _, df = table(spark, 50)
    for columns in (["other", "flag", "name"], ["flag"], list(df.columns)):
        places = df.select(interleaved(df, columns).alias("p")).collect()
        assert all(0 <= r.p < 1 << 63 for r in places)
    empty = df.limit(0)
    assert empty.select(interleaved(empty, ["name"])).count() == 0
    wide = spark.range(20).selectExpr(*[f"id % {i + 2} as c{i}" for i in range(70)])
    assert wide.select(interleaved(wide, wide.columns).alias("p")).distinct().count() > 5
