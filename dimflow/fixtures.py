"""Stand-ins for a warehouse's inputs, derived from the test tables by whole-table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimflow.functions.calendar import batch_id, ntz
from dimflow.operators.versioned import Wave, apply_snapshot
from dimflow.plans.layout import Usage
from dimflow.session import materialise

SECOND_WAVE = "1998-01-01 00:00:00"
THIRD_WAVE = "2000-01-01 00:00:00"
BATCH_FROM = "2024-01-15 00:00:00"
BASE_UNTIL = "2024-01-20 00:00:00"
CUSTOMER_TRACKED = ["c_nationkey", "c_mktsegment"]
PART_TRACKED = ["p_size", "p_retailprice"]

# How queries are taken to use the tables the layout queries profile.
USAGES = {
    "orders": Usage(("o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderdate", ("o_orderstatus",)),
    "lineitem": Usage(("l_linenumber", "l_suppkey"), None, ("l_returnflag", "l_linestatus", "l_linenumber")),
    "customer": Usage(("c_custkey",), None, ("c_nationkey", "c_mktsegment")),
    "events": Usage(("event_type",), "ts", ()),
    "supplier": Usage(("s_suppkey",), None, ("s_nationkey",)),
    "dim_nation": Usage(("n_nationkey",)),
}


# The declared schemas of the test tables: a read needs no look at the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    """A double of the test tables as the decimal the source would declare."""
    return F.col(column).cast("decimal(18,2)")


def customer_snapshot(spark: SparkSession, sf_dir: str, wave: int) -> DataFrame:
    """Customers as three successive loads see them.

    1: all but the segment that comes on later. 2: everyone; those in debt have moved. 3: those deep
    in debt have moved again, the wealthy are in another segment.
    """
    df = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"
    )
    if wave == 1:
        return df.where(F.col("c_mktsegment") != "MACHINERY").drop("c_acctbal")
    moves = (F.col("c_acctbal") < 0).cast("int")
    segment = F.col("c_mktsegment")
    if wave == 3:
        moves = moves + (F.col("c_acctbal") < -500).cast("int")
        segment = F.when(F.col("c_acctbal") > 9000, "CHANGED").otherwise(segment)
    return df.select(
        "code",
        "c_custkey",
        ((F.col("c_nationkey") + moves) % 25).alias("c_nationkey"),
        segment.alias("c_mktsegment"),
    )


def customer_waves(spark: SparkSession, sf_dir: str, upto: int) -> list[Wave]:
    """The customer dimension after each of the first ``upto`` loads.

    The first is a projection of written rows already; the second is written before the third load, as a
    job would.
    """
    waves: list[Wave] = []
    dim = None
    for number, as_of in ((1, None), (2, SECOND_WAVE), (3, THIRD_WAVE)):
        if number > upto:
            break
        if number == 3:
            dim = materialise(dim, "customers")
        snapshot = customer_snapshot(spark, sf_dir, number)
        waves.append(
            apply_snapshot(dim, snapshot, "customer_key", "code", CUSTOMER_TRACKED, as_of, order_by=["c_custkey"])
        )
        dim = waves[-1].dim
    return waves


def customer_dimension(spark: SparkSession, sf_dir: str, upto: int) -> DataFrame:
    """The customer dimension after ``upto`` loads, written: the optimizer knows its size."""
    return materialise(customer_waves(spark, sf_dir, upto)[-1].dim, "customers")


def part_snapshot(spark: SparkSession, sf_dir: str, wave: int) -> DataFrame:
    """Parts in two loads: in the second the economy parts have been measured again."""
    df = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("part_code"),
        "p_partkey",
        "p_type",
        "p_size",
        money("p_retailprice").alias("p_retailprice"),
    )
    if wave == 1:
        return df
    grown = (F.col("p_type") == "ECONOMY").cast("int")
    return df.withColumn("p_size", F.col("p_size") + grown)


def part_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = apply_snapshot(
        None, part_snapshot(spark, sf_dir, 1), "part_key", "part_code", PART_TRACKED, None, ["p_partkey"]
    )
    second = apply_snapshot(
        first.dim,
        part_snapshot(spark, sf_dir, 2),
        "part_key",
        "part_code",
        PART_TRACKED,
        THIRD_WAVE,
        ["p_partkey"],
    )
    return materialise(second.dim, "parts")


def certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping certificates per part, one per valid year count, from the day its size gives."""
    issued = F.date_add(F.to_date(F.lit("1995-01-01")), F.col("p_size") * 30)
    return (
        table(spark, sf_dir, "part")
        .withColumn("years", F.explode(F.array(F.lit(1), F.lit(2))))
        .select(
            F.concat_ws("-", "p_partkey", "years").alias("certificate_number"),
            "p_partkey",
            issued.alias("issued_date"),
            F.date_add(issued, F.col("years") * 365).alias("expiry_date"),
        )
    )


def supplier_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of each supplier: as many as its nation's number, up to 24, of all lengths, beginning a season apart."""
    begin = F.date_add(F.to_date(F.lit("1992-01-01")), (F.col("n") * 97 + F.col("s_nationkey") * 13).cast("int"))
    return (
        table(spark, sf_dir, "supplier")
        .where(F.col("s_nationkey") > 0)
        .withColumn("n", F.explode(F.sequence(F.lit(1), F.col("s_nationkey"))))
        .select(
            "s_suppkey",
            F.concat_ws("-", "s_suppkey", "n").alias("term"),
            begin.alias("valid_from"),
            F.date_add(begin, (F.col("n") * F.col("n") * 3).cast("int")).alias("valid_until"),
        )
    )


def event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(spark, sf_dir).where(F.col("ts") < ntz(BASE_UNTIL))


def event_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = event_rows(spark, sf_dir).withColumn("value", F.col("value") + F.lit(1000).cast("decimal(18,2)"))
    return changed.select(
        "event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value")
    ).where(F.col("ts") >= ntz(BATCH_FROM))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", money("value").alias("value")
    )


def turn_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations up to their first answer."""
    return table(spark, sf_dir, "conversations").where(F.col("turn") <= 1)


def turn_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All answers, edited, and every question after the first."""
    edited = F.when(F.col("role") == "assistant", F.concat("text", F.lit("#"))).otherwise(F.col("text"))
    return (
        table(spark, sf_dir, "conversations")
        .where((F.col("role") == "assistant") | (F.col("turn") > 1))
        .withColumn("text", edited)
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders: the transactions of the star."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        money("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("total_value"),
        "l_returnflag",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey"), "left"
    )


def custody(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as moves between suppliers; a signup comes from nowhere."""
    suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws("-", F.lit("LOT"), "user_id").alias("lot"),
        F.when(F.col("event_type") != "signup", F.col("user_id") % suppliers).alias("giver"),
        ((F.col("user_id") + 1) % suppliers).alias("taker"),
        "event_type",
        "ts",
        money("value").alias("amount"),
    )


def weekly_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user did in a week as moves, each from where the one before ended; of errors there is no record."""
    events = table(spark, sf_dir, "events").select(
        batch_id("user_id", "ts").alias("batch_id"), "event_id", "ts", "event_type", (F.col("event_id") * 7919 % 101).alias("to_node")
    )
    before = F.lag("to_node").over(Window.partitionBy("batch_id").orderBy("ts", "event_id"))
    return events.withColumn("from_node", before).where(F.col("event_type") != "error")


def tampered_orders(orders: DataFrame) -> DataFrame:
    """The orders with the priority of one of them changed."""
    return orders.withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderkey") == 1, "0-TAMPERED").otherwise(F.col("o_orderpriority")),
    )


def strayed_orders(orders: DataFrame) -> DataFrame:
    """A copy of the orders: one has another priority, the pending ones stand under negative keys."""
    pending = F.col("o_orderstatus") == "P"
    moved = orders.where(pending).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return tampered_orders(orders).where(~pending).unionByName(moved)


def restated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of the first load and later ones, under old stamps: pending ones are gone, urgent ones repriced."""
    stamped = order_feed(spark, sf_dir, 2).withColumn("updated_at", F.expr("o_orderdate + interval 10 years"))
    return stamped.where(F.col("o_orderstatus") != "P")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_totalprice", money("o_totalprice"))


def order_feed(spark: SparkSession, sf_dir: str, wave: int) -> DataFrame:
    """Orders as two loads see them: first those before the second wave, then all, the urgent ones repriced."""
    orders = order_rows(spark, sf_dir)
    stamped = orders.withColumn("updated_at", F.expr("o_orderdate + interval 10 years"))
    if wave == 1:
        return stamped.where(F.col("o_orderdate") < ntz(SECOND_WAVE))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    repriced = (F.col("o_totalprice") + F.lit(1)).cast("decimal(18,2)")
    return stamped.withColumns({
        "o_totalprice": F.when(urgent, repriced).otherwise(F.col("o_totalprice")),
        "updated_at": F.when(urgent, F.expr("o_orderdate + interval 20 years")).otherwise(F.col("updated_at")),
    })


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("c_acctbal", money("c_acctbal"))
