"""Values that hold much of a table: a key of many values is no safe distribution key if one of them is hot.

A frequent-items sketch of fixed size finds the candidates in one pass with partials; their rows are then counted
exactly. The fixed rules of ``layout`` stay as they are: this stands beside them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.names import sql_name
from dimflow.plans.layout import Usage, distribution, table_stats

#: The share of a table's rows from which a value is hot.
HOT_SHARE = 0.1
TRACKED = 10_000


def hot_values(df: DataFrame, table: str, keys: tuple[str, ...], share: float = HOT_SHARE) -> DataFrame:
    """``table_name``, ``column_name``, ``value`` (text), ``n_rows`` and ``share`` of each value that holds ``share`` of the rows.

    NULL is a value. A value with that share cannot be missing from the candidates: the sketch's error, the number of
    rows over three quarters of what it tracks, is far below it, and twice as many are taken as can have it.
    """
    if not TRACKED * share > 20:
        raise ValueError(f"shares below {20 / TRACKED} need a larger sketch")
    most, total, found = int(2 / share) + 1, F.count(F.lit(1)), []
    # A NULL is written as one mark and all other texts behind another.
    texts = {k: F.expr(f"coalesce(concat('=', cast({sql_name(k)} as string)), '0')") for k in keys}
    rows = df.select(*[texts[k].alias(f"k{i}") for i, k in enumerate(keys)])
    tops = [F.expr(f"transform(approx_top_k(k{i}, {most}, {TRACKED}), t -> t.item)").alias(f"k{i}") for i in range(len(keys))]
    # One row, with at most ``most`` values of each key.
    candidates = rows.agg(total.alias("n"), *tops).first()
    n_rows = candidates["n"]
    for i, key in enumerate(keys):
        counts = rows.where(F.col(f"k{i}").isin(list(candidates[f"k{i}"] or []))).groupBy(f"k{i}").agg(total.alias("n_rows"))
        found.append(counts.where(F.col("n_rows") >= share * n_rows).select(
            F.lit(table).alias("table_name"), F.lit(key).alias("column_name"),
            F.when(F.col(f"k{i}") != "0", F.expr(f"substring(k{i}, 2)")).alias("value"), "n_rows", (F.col("n_rows") / F.lit(float(max(n_rows, 1)))).alias("share"),
        ))
    return reduce(DataFrame.unionAll, found)


def hot_key_advice(tables: dict[str, DataFrame], usages: dict[str, Usage], share: float = HOT_SHARE) -> DataFrame:
    """The distribution advice of each table, with the hottest value of its key and whether the key is safe.

    ``hot_value``, ``hot_rows`` and ``hot_share`` are of the key's most frequent value if it is hot, the least text of equals; a table
    without a key has none. ``hot_action`` says what to do in Spark: a hot key's rows are salted before they are shuffled.
    """
    advice, hot = [], []
    for name, df in tables.items():
        keys = usages[name].join_keys
        advice.append(distribution(table_stats(df, name, keys)))
        if keys:
            hot.append(hot_values(df, name, keys, share))
    advice = reduce(DataFrame.unionAll, advice).select("table_name", "row_count", "diststyle", "distkey")
    if not hot:
        return advice.selectExpr("*", "cast(null as string) hot_value", "cast(null as bigint) hot_rows", "cast(null as double) hot_share",
                                 "cast(null as boolean) safe", "cast(null as string) hot_action")
    first = F.min(F.struct((-F.col("n_rows")).alias("minus"), "value", "share")).alias("top")
    top = reduce(DataFrame.unionAll, hot).groupBy("table_name", F.col("column_name").alias("distkey")).agg(first)
    safe = F.when(F.col("distkey").isNotNull(), F.col("top").isNull())
    return advice.join(top, ["table_name", "distkey"], "left").select(
        "table_name", "row_count", "diststyle", "distkey", F.col("top.value").alias("hot_value"), (-F.col("top.minus")).alias("hot_rows"),
        F.col("top.share").alias("hot_share"), safe.alias("safe"),
        F.when(~safe, F.concat(F.lit("salt "), F.col("distkey"), F.lit(" before shuffles"))).alias("hot_action"),
    )
