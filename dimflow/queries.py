"""Every operator as a query over the test tables; ``oracles.py`` has the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow import fixtures as fx
from dimflow.functions import calendar
from dimflow.operators import chains, digests, dimensions, facts, highwater, intervals, pointintime, quality, reconcile, trace, upsert
from dimflow.operators import versioned
from dimflow.plans import definitions, hotkeys, layout, sketches
from dimflow.plans.job import run_job
from dimflow.plans.star import CurrentDim, Star, VersionedDim
from dimflow.registry import TableSpec
from dimflow.session import configure, fresh_path, materialise, side_by_side
from dimflow.sources import export, history, load
from dimflow.sources.store import ANALYTICS, RAW, Store
from dimflow.streaming import upsert_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    REGISTRY[build.__name__] = run
    return run


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def instant(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def shown(dim: DataFrame) -> DataFrame:
    """A versioned dimension with its validity as text, as pandas has no year 9999."""
    return dim.withColumns({"valid_from": day("valid_from"), "valid_to": day("valid_to")})


# --- incremental load -------------------------------------------------------------------------


@query
def highwater_batch(spark, sf_dir):
    rows = highwater.past_mark(fx.table(spark, sf_dir, "events"), fx.BATCH_FROM, "ts")
    return rows.withColumn("ts", instant("ts"))


@query
def highwater_first_load(spark, sf_dir):
    rows = highwater.past_mark(fx.table(spark, sf_dir, "events"), updated_at="ts")
    return rows.withColumn("ts", instant("ts"))


@query
def highwater_state(spark, sf_dir):
    marks = [
        highwater.high_water(highwater.past_mark(fx.table(spark, sf_dir, name), updated_at=stamp), stamp).select(
            F.lit(name).alias("table_name"), instant("last_watermark").alias("last_watermark")
        )
        for name, stamp in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    return marks[0].unionByName(marks[1]).unionByName(marks[2])


def _events_shown(df):
    return df.withColumns({"ts": instant("ts"), "value": F.col("value").cast("double")})


@query
def upsert_single_key(spark, sf_dir):
    base, batch = fx.event_base(spark, sf_dir), fx.event_batch(spark, sf_dir)
    return _events_shown(upsert.keyed_upsert(base, batch, ["event_id"], "ts"))


@query
def upsert_composite_key(spark, sf_dir):
    return upsert.keyed_upsert(
        fx.turn_base(spark, sf_dir), fx.turn_batch(spark, sf_dir), ["conv_id", "turn"]
    )


@query
def upsert_replay(spark, sf_dir):
    batch = fx.event_batch(spark, sf_dir)
    once = upsert.keyed_upsert(fx.event_base(spark, sf_dir), batch, ["event_id"], "ts")
    return _events_shown(upsert.keyed_upsert(once, batch, ["event_id"], "ts"))


@query
def upsert_latest(spark, sf_dir):
    rows = fx.event_rows(spark, sf_dir).select("user_id", "event_type", "ts", "event_id", "value")
    return _events_shown(upsert.latest_per_key(rows, ["user_id", "event_type"], "ts"))


# --- dimensions -------------------------------------------------------------------------------


@query
def scd1_dim(spark, sf_dir):
    nation = fx.table(spark, sf_dir, "nation")
    region = fx.table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return dimensions.current_state(
        places.select("n_nationkey", "n_name", "r_name"), "location_key", ["n_nationkey"]
    )


@query
def surrogate_keys(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dimensions.current_state(orders, "order_key", ["o_custkey", "o_orderkey"])


@query
def scd2_initial(spark, sf_dir):
    return shown(fx.customer_waves(spark, sf_dir, 1)[-1].dim)


@query
def scd2_classify(spark, sf_dir):
    dim = fx.customer_waves(spark, sf_dir, 1)[-1].dim
    found = versioned.classify(dim, fx.customer_snapshot(spark, sf_dir, 2), "code", fx.CUSTOMER_TRACKED)
    return found.select("code", "c_nationkey", "c_mktsegment", "change")


@query
def scd2_second_wave(spark, sf_dir):
    return shown(fx.customer_waves(spark, sf_dir, 2)[-1].dim)


@query
def scd2_third_wave(spark, sf_dir):
    return shown(fx.customer_waves(spark, sf_dir, 3)[-1].dim)


@query
def scd2_noop(spark, sf_dir):
    dim = fx.customer_waves(spark, sf_dir, 3)[-1].dim
    replay = versioned.apply_snapshot(
        dim,
        fx.customer_snapshot(spark, sf_dir, 3),
        "customer_key",
        "code",
        fx.CUSTOMER_TRACKED,
        "2001-01-01 00:00:00",
        ["c_custkey"],
    )
    return shown(replay.dim)


@query
def scd2_key_coercion(spark, sf_dir):
    dim = fx.customer_waves(spark, sf_dir, 1)[-1].dim
    numeric = fx.customer_snapshot(spark, sf_dir, 1).withColumn("code", F.col("code").cast("bigint"))
    found = versioned.classify(dim, numeric, "code", fx.CUSTOMER_TRACKED)
    return found.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def _surveyed(spark, sf_dir, missing):
    df = fx.table(spark, sf_dir, "customer")
    return df.select(
        F.col("c_custkey").cast("string").alias("code"),
        F.when(~missing(F.col("c_acctbal")), F.col("c_nationkey")).alias("c_nationkey"),
    )


@query
def scd2_null_tracked(spark, sf_dir):
    first = versioned.initial_load(
        _surveyed(spark, sf_dir, lambda balance: balance > 8000), "customer_key", "code"
    )
    found = versioned.classify(
        first.dim, _surveyed(spark, sf_dir, lambda balance: balance > 9000), "code", ["c_nationkey"]
    )
    return found.select("code", "c_nationkey", "change")


@query
def scd2_summary(spark, sf_dir):
    rows = [
        wave.summary().select(F.lit(i).alias("wave"), "n_new_versions", "n_expired")
        for i, wave in enumerate(fx.customer_waves(spark, sf_dir, 3), start=1)
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def scd2_multi_version(spark, sf_dir):
    return versioned.multi_version_keys(fx.customer_waves(spark, sf_dir, 3)[-1].dim, "code")


@query
def effective_dated_dim(spark, sf_dir):
    dim = dimensions.effective_dated(
        fx.certificates(spark, sf_dir), "certificate_key", ["p_partkey", "certificate_number"]
    )
    return dim.withColumns({"issued_date": day("issued_date"), "expiry_date": day("expiry_date")})


@query
def effective_dated_lookup(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    found = dimensions.effective_lookup(
        lines,
        fx.certificates(spark, sf_dir),
        {"l_partkey": "p_partkey"},
        "l_shipdate",
        "issued_date",
        "expiry_date",
        {"certificate_number": "certificate_number"},
    )
    return found.withColumn("l_shipdate", day("l_shipdate"))


@query
def effective_deep_lookup(spark, sf_dir):
    """Ships of a supplier under the certificates of all its parts, many of which hold at the same time."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    found = intervals.effective_lookup_deep(
        lines, fx.supplier_terms(spark, sf_dir), {"l_suppkey": "s_suppkey"}, "l_shipdate", "valid_from", "valid_until",
        {"term": "term"}, ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"], deep=4,
    )
    return found.withColumn("l_shipdate", day("l_shipdate"))


@query
def dim_date(spark, sf_dir):
    orders, lines = fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem")
    dates = dimensions.date_dimension([F.col("o_orderdate"), F.col("l_shipdate")], [orders, lines])
    return dates.withColumn("date", day("date"))


# --- point in time and facts --------------------------------------------------------------------


def _orders_resolved(spark, sf_dir, upto):
    dim = fx.customer_dimension(spark, sf_dir, upto)
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return pointintime.resolve(orders, dim, "customer_key", "code", "o_custkey", "o_orderdate")


@query
def pit_join(spark, sf_dir):
    return _orders_resolved(spark, sf_dir, 2).withColumn("o_orderdate", day("o_orderdate"))


@query
def pit_three_versions(spark, sf_dir):
    return _orders_resolved(spark, sf_dir, 3).withColumn("o_orderdate", day("o_orderdate"))


@query
def pit_deep_history(spark, sf_dir):
    dim = fx.customer_dimension(spark, sf_dir, 3)
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = pointintime.resolve_deep(
        orders, dim, "customer_key", "code", "o_custkey", "o_orderdate", deep=1, cell="month"
    )
    return found.withColumn("o_orderdate", day("o_orderdate"))


@query
def pit_coverage(spark, sf_dir):
    resolved = _orders_resolved(spark, sf_dir, 3).withColumn("year", F.year("o_orderdate"))
    return pointintime.coverage(resolved, "customer_key", ["year"])


SALES = facts.FactSpec(
    name="fact_sales",
    source="sales",
    id_col="l_orderkey",
    sk_col="transaction_sk",
    date_col="l_shipdate",
    columns=(
        "transaction_sk", "l_linenumber", "customer_key", "part_key", "type_key", "node_key", "date_key",
        "l_shipdate", "quantity", "total_value", "l_returnflag", "o_orderstatus",
    ),
    versioned=(
        # Parts first: sales come from a join by part.
        facts.VersionedRef("dim_part", "part_key", "p_partkey", "l_partkey"),
        facts.VersionedRef("dim_customer", "customer_key", "c_custkey", "o_custkey"),
    ),
    current=(
        facts.CurrentRef("dim_type", "type_key", "p_type", "p_type", "type_key"),
        facts.CurrentRef("dim_node", "node_key", "s_suppkey", "l_suppkey", "node_key"),
    ),
)
MOVES = facts.FactSpec(
    name="fact_moves",
    source="custody",
    id_col="event_id",
    sk_col="move_id",
    date_col="ts",
    columns=("move_id", "lot", "giver_key", "taker_key", "date_key", "event_type", "ts", "amount"),
    current=(
        facts.CurrentRef("dim_node", "node_key", "s_suppkey", "giver", "giver_key"),
        facts.CurrentRef("dim_node", "node_key", "s_suppkey", "taker", "taker_key"),
    ),
)


def _node_dim(spark, sf_dir):
    supplier = fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return dimensions.current_state(supplier, "node_key", ["s_suppkey"])


def _fact_sales(spark, sf_dir):
    types = fx.table(spark, sf_dir, "part").select("p_type").distinct()
    customers, parts, type_dim, node_dim = side_by_side(
        spark,
        lambda build: build(),
        [
            lambda: fx.customer_dimension(spark, sf_dir, 2),
            lambda: fx.part_dimension(spark, sf_dir),
            lambda: dimensions.current_state(types, "type_key", ["p_type"]),
            lambda: _node_dim(spark, sf_dir),
        ],
    )
    customer_ids, part_ids = fx.customer_snapshot(spark, sf_dir, 2), fx.part_snapshot(spark, sf_dir, 2)
    lookups = [
        pointintime.entity_versions(customer_ids, customers, "c_custkey", "customer_key", "code"),
        pointintime.entity_versions(part_ids, parts, "p_partkey", "part_key", "part_code"),
    ]
    versions = dict(
        zip(("dim_customer", "dim_part"), side_by_side(spark, lambda v: materialise(v, "versions"), lookups))
    )
    dims = {"dim_type": type_dim, "dim_node": node_dim}
    return facts.build_fact(fx.sales(spark, sf_dir), SALES, versions, dims), customers, parts


def _fact_moves(spark, sf_dir):
    return facts.build_fact(fx.custody(spark, sf_dir), MOVES, {}, {"dim_node": _node_dim(spark, sf_dir)})


@query
def fact_transactions(spark, sf_dir):
    fact = _fact_sales(spark, sf_dir)[0]
    return fact.withColumns(
        {
            "l_shipdate": day("l_shipdate"),
            "quantity": F.col("quantity").cast("double"),
            "total_value": F.col("total_value").cast("double"),
        }
    )


@query
def fact_events(spark, sf_dir):
    return _fact_moves(spark, sf_dir).withColumns(
        {"ts": instant("ts"), "amount": F.col("amount").cast("double")}
    )


@query
def fact_summary(spark, sf_dir):
    sales, customers, parts = _fact_sales(spark, sf_dir)
    return facts.row_counts(
        {
            "dim_customer": customers,
            "dim_part": parts,
            "fact_sales": sales,
            "fact_moves": _fact_moves(spark, sf_dir),
        }
    )


# --- checks -------------------------------------------------------------------------------------


@query
def duplicate_candidates(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    found = quality.duplicate_candidates(documents, F.sha2("text", 256), "identity")
    return quality.review_order(found, "identity")


@query
def duplicate_members(spark, sf_dir):
    customer = fx.table(spark, sf_dir, "customer").withColumn("member", F.col("c_custkey"))
    return quality.duplicate_members(customer, "c_nationkey", "identity", "member")


@query
def row_count_recon(spark, sf_dir):
    checks = reconcile.compare(_pairs(spark, sf_dir))
    return checks.where(F.col("check_type") == "row_count")


@query
def row_hash(spark, sf_dir):
    orders = fx.order_rows(spark, sf_dir)
    return reconcile.fingerprint(orders).select("row_count", "row_hash")


@query
def row_hash_strict(spark, sf_dir):
    return reconcile.fingerprint(fx.table(spark, sf_dir, "documents"), strict=True)


@query
def silent_change(spark, sf_dir):
    orders = fx.order_rows(spark, sf_dir)
    return reconcile.compare([reconcile.Pair("orders", orders, fx.tampered_orders(orders))])


def _pairs(spark, sf_dir):
    orders, customers = fx.order_rows(spark, sf_dir), fx.customer_rows(spark, sf_dir)
    nation = fx.table(spark, sf_dir, "nation")
    return [
        reconcile.Pair("orders", orders, fx.tampered_orders(orders)),
        reconcile.Pair("customer", customers, customers.where(F.col("c_mktsegment") != "MACHINERY")),
        reconcile.Pair("nation", nation, nation.orderBy(F.col("n_name").desc())),
    ]


@query
def recon_report(spark, sf_dir):
    return reconcile.report(_pairs(spark, sf_dir), "run-1").drop("checked_at")


@query
def recon_all_passed(spark, sf_dir):
    return reconcile.all_passed(reconcile.compare(_pairs(spark, sf_dir)))


@query
def recon_diff_rows(spark, sf_dir):
    """Which orders differ from a copy in which one is changed, pending ones lack, and others stand under keys of their own."""
    orders = fx.order_rows(spark, sf_dir)
    return digests.diff_rows(orders, fx.strayed_orders(orders), digests.Ranges(("o_orderkey",), width=64, fanout=16))


@query
def recon_diff_turns(spark, sf_dir):
    """Keys of two columns: answers were edited, later questions are new."""
    turns = fx.table(spark, sf_dir, "conversations")
    edited = upsert.keyed_upsert(fx.turn_base(spark, sf_dir), fx.turn_batch(spark, sf_dir), ["conv_id", "turn"])
    return digests.diff_rows(turns, edited.where("turn <= 3"), digests.Ranges(("conv_id", "turn"), leaves=4096))


# --- layout ---------------------------------------------------------------------------------------


def _profiled(spark, sf_dir):
    names = ("orders", "lineitem", "customer", "events", "supplier")
    tables = {name: fx.table(spark, sf_dir, name) for name in names}
    return {**tables, "dim_nation": fx.table(spark, sf_dir, "nation")}


@query
def key_cardinality(spark, sf_dir):
    return layout.key_cardinality(layout.gather(_profiled(spark, sf_dir), fx.USAGES))


@query
def sketch_cardinality(spark, sf_dir):
    """Distinct counts merged from the sketches of a table's directories after two loads, beside exact ones."""
    store, keys = _store(spark), ("user_id", "event_type", "event_id")
    for rows in (fx.event_base(spark, sf_dir), fx.event_batch(spark, sf_dir)):
        store.upsert(RAW, EVENTS, rows)
        sketches.refresh(store, RAW, "events", keys)
    kept = layout.key_cardinality(sketches.kept_stats(store, RAW, "events", keys))
    exact = layout.key_cardinality(layout.table_stats(store.read(RAW, "events"), "events", keys))
    near = F.abs(kept["distinct_count"] - exact["distinct_count"]) <= 0.04 * exact["distinct_count"]
    both = kept.join(exact, kept["column_name"] == exact["column_name"])
    return both.select(kept["table_name"], kept["column_name"], kept["row_count"], exact["distinct_count"], near.alias("within_error"))


@query
def hot_key_advice(spark, sf_dir):
    """Orders as they are, and with the urgent ones on one customer: as many keys, one of them hot."""
    orders = fx.order_rows(spark, sf_dir)
    customer = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0)).otherwise(F.col("o_custkey"))
    usage = layout.Usage(("o_orderkey",)), layout.Usage(("o_custkey",)), layout.Usage(("o_orderpriority",))
    tables = {"by_order": orders, "by_customer": orders.withColumn("o_custkey", customer.cast("bigint")), "by_priority": orders}
    return hotkeys.hot_key_advice(tables, dict(zip(tables, usage)))


@query
def dist_advice(spark, sf_dir):
    report = layout.layout_report(_profiled(spark, sf_dir), fx.USAGES)
    return report.select("table_name", "row_count", "diststyle", "distkey", F.col("rationale")[0].alias("rationale"))


@query
def sort_advice(spark, sf_dir):
    report = layout.layout_report(_profiled(spark, sf_dir), fx.USAGES)
    return report.select(
        "table_name",
        "row_count",
        "sortkey_type",
        F.array_join("sortkey_columns", ",").alias("sortkey_columns"),
        F.col("rationale")[1].alias("rationale"),
    )


@query
def layout_report(spark, sf_dir):
    report = layout.layout_report(_profiled(spark, sf_dir), fx.USAGES)
    return report.withColumns(
        {
            "sortkey_columns": F.array_join("sortkey_columns", ","),
            "rationale": F.array_join("rationale", " "),
        }
    )


@query
def column_profile(spark, sf_dir):
    rows = [
        definitions.column_profile(fx.customer_rows(spark, sf_dir), "customer"),
        definitions.column_profile(fx.table(spark, sf_dir, "part"), "part"),
        definitions.column_profile(fx.table(spark, sf_dir, "documents"), "documents"),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def column_profile_bytes(spark, sf_dir):
    """Widths in bytes, as the target counts them."""
    return definitions.column_profile(fx.table(spark, sf_dir, "documents"), "documents", in_bytes=True)


@query
def create_table_text(spark, sf_dir):
    return definitions.create_tables(_profiled(spark, sf_dir), fx.USAGES)


# --- batches ----------------------------------------------------------------------------------------


def _lots(spark, sf_dir):
    return fx.event_rows(spark, sf_dir).where(F.col("event_type") == "purchase")


def _batch_events(spark, sf_dir):
    """What happened to the batches: each one's lots, carrying the batch total less the errors found.

    Events of a node and week without a lot carry nothing.
    """
    rows = fx.event_rows(spark, sf_dir)
    totals = trace.assemble(_lots(spark, sf_dir), "user_id", "ts", "value")
    moves = rows.where(F.col("event_type") != "purchase").select(
        calendar.batch_id("user_id", "ts").alias("batch_id"), "event_id", "ts", "event_type", "value"
    )
    lost = F.when((F.col("event_type") == "error") & (F.col("value") > 250), F.lit(1)).otherwise(F.lit(0))
    return moves.join(totals, "batch_id", "left").select(
        "batch_id", "event_id", "ts", "event_type", (F.col("total_quantity") - lost).alias("carried")
    )


@query
def batch_assembly(spark, sf_dir):
    batches = trace.assemble(_lots(spark, sf_dir), "user_id", "ts", "value")
    return batches.withColumns(
        {
            "total_quantity": F.col("total_quantity").cast("double"),
            "last_transaction_at": instant("last_transaction_at"),
        }
    )


@query
def batch_links(spark, sf_dir):
    rows = trace.links(_lots(spark, sf_dir), "user_id", "ts", "value", "event_id")
    return rows.withColumns(
        {
            "quantity_allocated": F.col("quantity_allocated").cast("double"),
            "updated_at": instant("updated_at"),
        }
    )


@query
def batch_trace(spark, sf_dir):
    lots = _lots(spark, sf_dir)
    links = trace.links(lots, "user_id", "ts", "value", "event_id").drop("updated_at")
    sources = lots.select(F.col("event_id").alias("transaction_id"), F.col("user_id").alias("seller"))
    events = _batch_events(spark, sf_dir).select("batch_id", "event_id", "ts", "event_type")
    found = trace.trace(links, sources, "transaction_id", events, "ts", "event_id")
    return found.withColumns(
        {"quantity_allocated": F.col("quantity_allocated").cast("double"), "ts": instant("ts")}
    )


@query
def mass_balance(spark, sf_dir):
    links = trace.links(_lots(spark, sf_dir), "user_id", "ts", "value", "event_id")
    found = trace.mass_balance(links, _batch_events(spark, sf_dir), "carried")
    return found.withColumns(
        {c: F.col(c).cast("double") for c in ("allocated", "least_carried", "most_carried")}
    )


@query
def custody_chain(spark, sf_dir):
    """Each user's week as moves between nodes, of which the records of errors are lost."""
    return chains.chains(fx.weekly_moves(spark, sf_dir), "batch_id", "event_id", "from_node", "to_node")


@query
def custody_report(spark, sf_dir):
    return chains.chain_report(chains.chains(fx.weekly_moves(spark, sf_dir), "batch_id", "event_id", "from_node", "to_node"))


# --- stored tables: these write under the shared folder ----------------------------------------------


EVENTS = TableSpec("events", ("event_id",), incremental=True, updated_at="ts")
TURNS = TableSpec("conversations", ("conv_id", "turn"), incremental=True)


def _store(spark):
    return Store(spark, fresh_path(spark, "store"))


@query
def full_replace(spark, sf_dir):
    store, nation = _store(spark), fx.table(spark, sf_dir, "nation")
    store.replace(RAW, "nation", nation)
    return store.replace(RAW, "nation", nation.withColumn("n_name", F.concat(F.lit("new "), F.col("n_name"))))


@query
def stored_upsert(spark, sf_dir):
    store = _store(spark)
    store.upsert(RAW, EVENTS, fx.event_base(spark, sf_dir))
    store.upsert(RAW, EVENTS, fx.event_batch(spark, sf_dir))
    store.upsert(RAW, EVENTS, fx.event_batch(spark, sf_dir))
    return _events_shown(store.read(RAW, "events"))


@query
def stored_upsert_by_range(spark, sf_dir):
    store = _store(spark)
    recent = TableSpec("events", ("event_id",), incremental=True, updated_at="ts", id_range=2000)
    store.upsert(RAW, recent, fx.event_base(spark, sf_dir))
    store.upsert(RAW, recent, fx.event_batch(spark, sf_dir))
    return _events_shown(store.read(RAW, "events"))


@query
def stored_upsert_rebucketed(spark, sf_dir):
    """The bucketing changes twice while the table is in use."""
    store = _store(spark)
    for bucketing in ({}, {"buckets": 16}, {"id_range": 2000}):
        spec = TableSpec("events", ("event_id",), incremental=True, updated_at="ts", **bucketing)
        store.upsert(RAW, spec, (fx.event_batch if bucketing else fx.event_base)(spark, sf_dir))
    return _events_shown(store.read(RAW, "events"))


@query
def stored_upsert_late(spark, sf_dir):
    """A later batch with older stamps changes nothing."""
    store = _store(spark)
    store.upsert(RAW, EVENTS, fx.event_base(spark, sf_dir))
    store.upsert(RAW, EVENTS, fx.event_batch(spark, sf_dir))
    late = fx.event_batch(spark, sf_dir).withColumn("ts", F.expr("ts - interval 5 years"))
    store.upsert(RAW, EVENTS, late.withColumn("value", -F.col("value")))
    return _events_shown(store.read(RAW, "events"))


@query
def first_load_all_rows(spark, sf_dir):
    """Without a mark nothing is too old to be loaded."""
    store = _store(spark)
    orders = TableSpec("orders", ("o_orderkey",), incremental=True, updated_at="o_orderdate")
    load.run(store, lambda name: fx.table(spark, sf_dir, name), [orders])
    return store.read(RAW, "orders").select("o_orderkey", day("o_orderdate").alias("day"))


@query
def repair_load(spark, sf_dir):
    """Orders change at the source without their stamps, old ones come, others go: a repair finds them all."""
    store, spec = _store(spark), TableSpec("orders", ("o_orderkey",), incremental=True)
    load.run(store, lambda name: fx.order_feed(spark, sf_dir, 1), [spec])
    found = load.repair(store, lambda name: fx.restated_orders(spark, sf_dir), spec, digests.Ranges(spec.keys, width=256, fanout=8))
    rows = store.read(RAW, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), instant("updated_at").alias("updated_at"))
    return rows.withColumns({k: F.lit(n).cast("bigint") for k, n in vars(found).items()})


@query
def stored_upsert_composite(spark, sf_dir):
    store = _store(spark)
    store.upsert(RAW, TURNS, fx.turn_base(spark, sf_dir))
    store.upsert(RAW, TURNS, fx.turn_batch(spark, sf_dir))
    return store.read(RAW, "conversations")


def _migration_source(spark, sf_dir, wave):
    """The test tables as an operational source; rows are stamped as of their migration."""

    def read(name):
        if name == "customer":
            return fx.customer_snapshot(spark, sf_dir, wave)
        if name == "orders":
            stamped = F.expr("o_orderdate + interval 10 years").alias("updated_at")
            return fx.order_rows(spark, sf_dir).select("*", stamped)
        if name == "events":
            return fx.custody(spark, sf_dir).withColumnRenamed("ts", "updated_at")
        return fx.table(spark, sf_dir, name)

    return read


MIGRATED = [
    TableSpec("nation", ("n_nationkey",)),
    TableSpec("supplier", ("s_suppkey",)),
    TableSpec("customer", ("c_custkey",), natural_key="code"),
    TableSpec("orders", ("o_orderkey",), incremental=True),
    TableSpec("events", ("event_id",), incremental=True),
]
MIGRATED_STAR = Star(
    versioned=(
        VersionedDim("dim_customer", "customer", "customer_key", "code", "c_custkey", tuple(fx.CUSTOMER_TRACKED)),
    ),
    current=(
        CurrentDim("dim_nation", "nation", "nation_key", "n_nationkey"),
        CurrentDim("dim_node", "supplier", "node_key", "s_suppkey"),
    ),
    facts=(
        facts.FactSpec(
            name="fact_orders",
            source="orders",
            id_col="o_orderkey",
            sk_col="order_sk",
            date_col="o_orderdate",
            columns=("order_sk", "customer_key", "date_key", "o_totalprice", "o_orderpriority"),
            versioned=(facts.VersionedRef("dim_customer", "customer_key", "c_custkey", "o_custkey"),),
        ),
        facts.FactSpec(
            name="fact_moves",
            source="events",
            id_col="event_id",
            sk_col="move_id",
            date_col="updated_at",
            columns=("move_id", "lot", "giver_key", "taker_key", "date_key", "event_type", "amount"),
            current=MOVES.current,
        ),
    ),
)


def _migrated(spark, sf_dir, orders=None):
    """The star after two runs of the job; the second builds only what the first one's facts lack."""
    store = _store(spark)
    for wave in (1, 2):
        given = _migration_source(spark, sf_dir, wave)
        source = given if orders is None else lambda name: orders(spark, sf_dir, wave) if name == "orders" else given(name)
        run_job(store, source, MIGRATED, MIGRATED_STAR, as_of=fx.SECOND_WAVE, run_id=f"run-{wave}")
    return store


@query
def registry_load_counts(spark, sf_dir):
    store, source = _store(spark), _migration_source(spark, sf_dir, 2)
    first = load.run(store, source, MIGRATED).withColumn("run", F.lit(1))
    return first.unionByName(load.run(store, source, MIGRATED).withColumn("run", F.lit(2)))


@query
def job_fact(spark, sf_dir):
    fact = _migrated(spark, sf_dir).read(ANALYTICS, "fact_orders")
    return fact.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query
def job_fact_incremental(spark, sf_dir):
    """The second run brings new orders, other prices for old ones, new customers and customers who moved."""
    fact = _migrated(spark, sf_dir, fx.order_feed).read(ANALYTICS, "fact_orders")
    return fact.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query
def job_wave_counts(spark, sf_dir):
    return _migrated(spark, sf_dir).audit("dimension_waves")


def _stored_waves(spark, sf_dir):
    store = _store(spark)
    for wave, as_of in ((1, calendar.INCEPTION), (2, fx.SECOND_WAVE), (3, fx.THIRD_WAVE)):
        snapshot = fx.customer_snapshot(spark, sf_dir, wave)
        history.apply_wave(
            store, ANALYTICS, "dim_customer", snapshot, "customer_key", "code", fx.CUSTOMER_TRACKED, as_of, ["c_custkey"]
        )
    return store


@query
def scd2_stored(spark, sf_dir):
    """Three waves, each applied to the stored current versions."""
    return shown(_stored_waves(spark, sf_dir).read(ANALYTICS, "dim_customer"))


@query
def scd2_stored_current(spark, sf_dir):
    return shown(_stored_waves(spark, sf_dir).current(ANALYTICS, "dim_customer"))


@query
def scd1_stable_keys(spark, sf_dir):
    """The second load has customers in between; those of the first keep their keys."""
    store = _store(spark)
    for wave in (1, 2):
        rows = fx.customer_snapshot(spark, sf_dir, wave)
        dim = history.stable_keys(store, ANALYTICS, "customer_keys", rows, "customer_key", ["c_custkey"])
    return dim


@query
def stored_upsert_split(spark, sf_dir):
    """Buckets above a hundred rows are split."""
    store = _store(spark)
    spec = TableSpec("events", ("event_id",), incremental=True, updated_at="ts", split_rows=100)
    store.upsert(RAW, spec, fx.event_base(spark, sf_dir))
    store.upsert(RAW, spec, fx.event_batch(spark, sf_dir))
    return _events_shown(store.read(RAW, "events"))


@query
def stream_replay(spark, sf_dir):
    """Both micro-batches come again under their numbers, with other values: the table has them already."""
    store = _store(spark)
    for number, rows in enumerate([fx.event_base(spark, sf_dir), fx.event_batch(spark, sf_dir)] * 2):
        given = rows if number < 2 else rows.withColumn("value", -F.col("value"))
        store.upsert(RAW, EVENTS, given, stream=("feed", number % 2))
    return _events_shown(store.read(RAW, "events"))


@query
def audit_log(spark, sf_dir):
    store, source = _store(spark), _migration_source(spark, sf_dir, 1)
    run_job(store, source, MIGRATED, MIGRATED_STAR, as_of=fx.SECOND_WAVE, run_id="run-1")
    run_job(store, source, MIGRATED, MIGRATED_STAR, dry_run=True, run_id="run-2")
    checks = store.audit("validation_results").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_checks"), F.count_if("passed").alias("n_passed")
    )
    steps = store.audit("pipeline_runs").select("run_id", "step", "status")
    return steps.join(checks, "run_id", "left")


@query
def export_roundtrip(spark, sf_dir):
    location = fresh_path(spark, "exports")
    tables = {"orders": fx.order_rows(spark, sf_dir), "lineitem": fx.table(spark, sf_dir, "lineitem")}
    pairs = []
    for name, df in tables.items():
        path = export.write_export(df, location, name, fx.USAGES[name])
        pairs.append(reconcile.Pair(name, df, spark.read.schema(df.schema).parquet(path)))
    return reconcile.compare(pairs).select("table_name", "check_type", "passed")


@query
def stream_upsert(spark, sf_dir):
    store, landing = _store(spark), fresh_path(spark, "landing")
    base, batch = fx.event_base(spark, sf_dir), fx.event_batch(spark, sf_dir)
    for rows in (base, batch):
        rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(base.schema).parquet(landing)
        upsert_stream(stream, store, RAW, EVENTS, f"{landing}-checkpoint").awaitTermination()
    return _events_shown(store.read(RAW, "events"))
