"""The query catalogue in SQL, for an independent engine to check the results against."""

from __future__ import annotations

CUSTOMER_SNAPSHOTS = """
s1 as (select cast(c_custkey as varchar) code, c_custkey, c_nationkey, c_mktsegment
       from customer where c_mktsegment <> 'MACHINERY'),
s2 as (select cast(c_custkey as varchar) code, c_custkey,
              case when c_acctbal < 0 then (c_nationkey + 1) % 25 else c_nationkey end c_nationkey, c_mktsegment
       from customer),
s3 as (select cast(c_custkey as varchar) code, c_custkey,
              case when c_acctbal < -500 then (c_nationkey + 2) % 25
                   when c_acctbal < 0 then (c_nationkey + 1) % 25 else c_nationkey end c_nationkey,
              case when c_acctbal > 9000 then 'CHANGED' else c_mktsegment end c_mktsegment
       from customer)"""


def _wave(before: str, snapshot: str, after: str, as_of: str) -> str:
    """CTEs that apply ``snapshot`` to dimension ``before``, giving ``after``."""
    return f"""
c_{after} as (select s.*, d.code is null is_new
              from {snapshot} s left join (select * from {before} where cur) d on s.code = d.code
              where d.code is null or s.c_nationkey is distinct from d.c_nationkey
                 or s.c_mktsegment is distinct from d.c_mktsegment),
{after} as (select d.k, d.code, d.c_custkey, d.c_nationkey, d.c_mktsegment, d.vf,
                   case when d.cur and c.code is not null then timestamp '{as_of}' else d.vt end vt,
                   d.cur and c.code is null cur
            from {before} d left join c_{after} c on d.code = c.code
            union all
            select (select max(k) from {before})
                   + row_number() over (order by case when is_new then 0 else 1 end, c_custkey),
                   code, c_custkey, c_nationkey, c_mktsegment,
                   case when is_new then timestamp '1900-01-01' else timestamp '{as_of}' end,
                   timestamp '9999-12-31', true
            from c_{after})"""


WAVES = (
    f"with {CUSTOMER_SNAPSHOTS},"
    """
d1 as (select row_number() over (order by c_custkey) k, s1.*, timestamp '1900-01-01' vf,
              timestamp '9999-12-31' vt, true cur from s1),"""
    f"{_wave('d1', 's2', 'd2', '1998-01-01')},{_wave('d2', 's3', 'd3', '2000-01-01')}"
)


def _dim(name: str) -> str:
    return f"""{WAVES}
select k as customer_key, code, c_custkey, c_nationkey, c_mktsegment, strftime(vf, '%Y-%m-%d') as valid_from,
       strftime(vt, '%Y-%m-%d') as valid_to, cur as is_current from {name}"""


def _resolved(name: str) -> str:
    return f"""{WAVES}
select o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, k as customer_key
from orders left join {name} on cast(o_custkey as varchar) = code and o_orderdate >= vf and o_orderdate < vt"""


TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
EVENTS = f"event_id, {TS.format('ts')} as ts, user_id, event_type"
UPSERTED = f"""
select {EVENTS}, cast(cast(value as decimal(18,2)) as double) as value from events where ts < timestamp '2024-01-15'
union all
select {EVENTS}, cast(cast(value as decimal(18,2)) + 1000 as double) from events where ts >= timestamp '2024-01-15'"""

PARTS = """
p1 as (select row_number() over (order by p_partkey) k, p_partkey, p_type from part),
p2 as (select k, p_partkey, timestamp '1900-01-01' vf,
              case when p_type = 'ECONOMY' then timestamp '2000-01-01' else timestamp '9999-12-31' end vt
       from p1
       union all
       select (select max(k) from p1) + row_number() over (order by p_partkey), p_partkey,
              timestamp '2000-01-01', timestamp '9999-12-31'
       from p1 where p_type = 'ECONOMY')"""
SALES = f"""{WAVES},{PARTS},
types as (select row_number() over (order by p_type) type_key, p_type from (select distinct p_type from part)),
nodes as (select row_number() over (order by s_suppkey) node_key, s_suppkey from supplier),
sales as (
  select l_orderkey as transaction_sk, l_linenumber, c.k as customer_key, pv.k as part_key, type_key, node_key,
         cast(strftime(l_shipdate, '%Y%m%d') as integer) as date_key,
         strftime(l_shipdate, '%Y-%m-%d') as l_shipdate, cast(cast(l_quantity as decimal(18,2)) as double) as quantity,
         cast(cast(l_extendedprice as decimal(18,2)) as double) as total_value, l_returnflag, o_orderstatus
  from lineitem join orders on l_orderkey = o_orderkey left join part p on l_partkey = p.p_partkey
  left join d2 c on o_custkey = c.c_custkey and lineitem.l_shipdate >= c.vf and lineitem.l_shipdate < c.vt
  left join p2 pv on l_partkey = pv.p_partkey and lineitem.l_shipdate >= pv.vf and lineitem.l_shipdate < pv.vt
  left join types t on p.p_type = t.p_type left join nodes n on l_suppkey = n.s_suppkey)"""
MOVES = f"""
select event_id as move_id, 'LOT-' || user_id as lot, f.node_key as giver_key, t.node_key as taker_key,
       cast(strftime(ts, '%Y%m%d') as integer) as date_key, event_type, {TS.format('ts')} as ts,
       cast(cast(value as decimal(18,2)) as double) as amount
from (select *, case when event_type <> 'signup' then user_id % (select count(*) from supplier) end from_node,
             (user_id + 1) % (select count(*) from supplier) to_node from events) e
left join nodes f on from_node = f.s_suppkey left join nodes t on to_node = t.s_suppkey"""
NODES = "nodes as (select row_number() over (order by s_suppkey) node_key, s_suppkey from supplier)"

CERTIFICATES = """
certs as (select p_partkey || '-' || years as certificate_number, p_partkey,
                 date '1995-01-01' + p_size * 30 as issued_date,
                 date '1995-01-01' + p_size * 30 + years * 365 as expiry_date
          from part, (values (1), (2)) y(years))"""


def _fold(text: str, table: str) -> str:
    """Count and checksum of a table whose rows read as ``text``."""
    return f"""select count(*) as row_count,
       cast(coalesce(bit_xor(('0x' || substr(sha256({text}), 49, 16))::ubigint), 0) as varchar) as row_hash
from {table}"""


ORDER_TEXT = (
    "concat(o_orderkey, '|', o_custkey, '|', o_orderstatus, '|', cast(o_totalprice as decimal(18,2)), '|', "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), '|', o_orderpriority)"
)
CUSTOMER_TEXT = (
    "concat(c_custkey, '|', c_name, '|', c_nationkey, '|', cast(c_acctbal as decimal(18,2)), '|', c_mktsegment)"
)
NATION_TEXT = "concat(n_nationkey, '|', n_name, '|', n_regionkey)"
TAMPERED = """(select * replace (case when o_orderkey = 1 then '0-TAMPERED' else o_orderpriority end
                                 as o_orderpriority) from orders)"""


def _checks(*pairs: tuple[str, str, str, str]) -> str:
    """Row count and checksum checks of (table, text, source, target)."""
    rows = []
    for table, text, source, target in pairs:
        for check in ("row_count", "row_hash"):
            rows.append(
                f"select '{table}' as table_name, '{check}' as check_type, "
                f"cast(s.{check} as varchar) as source_value, cast(t.{check} as varchar) as target_value, "
                f"s.{check} = t.{check} as passed from ({_fold(text, source)}) s, ({_fold(text, target)}) t"
            )
    return "\nunion all\n".join(rows)


CHECKS = _checks(
    ("orders", ORDER_TEXT, "orders", TAMPERED),
    ("customer", CUSTOMER_TEXT, "customer", "(select * from customer where c_mktsegment <> 'MACHINERY')"),
    ("nation", NATION_TEXT, "nation", "nation"),
)

ESCAPED = "replace(replace({}, '\\', '\\\\'), '|', '\\|')"
DOCUMENT_TEXT = "concat(doc_id, '|', {}, '|', {}, '|', {}, '|', n_chars)".format(
    *[f"coalesce({ESCAPED.format(c)}, '\\N')" for c in ("text", "lang", "source")]
)
STRICT = f"""
with h as (select substr(sha256({DOCUMENT_TEXT}), 49, 16) h from documents),
f as (select count(*) n, bit_xor(('0x' || h)::ubigint) x, sum(('0x' || substr(h, 1, 8))::ubigint) hi,
             sum(('0x' || substr(h, 9, 8))::ubigint) lo from h)
select n as row_count, concat(x, ':', hi, ':', lo) as row_hash from f"""

# table -> (join keys, range filter, equality filters)
PROFILES = {
    "orders": (("o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderdate", ("o_orderstatus",)),
    "lineitem": (("l_linenumber", "l_suppkey"), None, ("l_returnflag", "l_linestatus", "l_linenumber")),
    "customer": (("c_custkey",), None, ("c_nationkey", "c_mktsegment")),
    "events": (("event_type",), "ts", ()),
    "supplier": (("s_suppkey",), None, ("s_nationkey",)),
    "dim_nation": (("n_nationkey",), None, ()),
}


def _cardinality() -> str:
    rows = []
    for table, (keys, _, _) in PROFILES.items():
        for position, key in enumerate(keys):
            rows.append(
                f"select '{table}' as table_name, '{key}' as column_name, {position} as position, "
                f"count(*) as row_count, count(distinct {key}) as distinct_count, "
                f"count(distinct {key}) / count(*) as ratio from {table.removeprefix('dim_')}"
            )
    return "\nunion all\n".join(rows)


def _sorts() -> str:
    """The sort advice, worked out by hand for each profile above."""
    rows = {
        "orders": ("COMPOUND", "o_orderdate,o_orderstatus",
                   "COMPOUND SORTKEY(o_orderdate, o_orderstatus): o_orderdate is the dominant range filter "
                   "(leading column), o_orderstatus is the next most common equality filter."),
        "lineitem": ("INTERLEAVED", "l_returnflag,l_linestatus,l_linenumber",
                     "INTERLEAVED SORTKEY: filter pattern varies across 3 unrelated columns with no single "
                     "dominant one -- costs more to VACUUM REINDEX than a compound key."),
        "customer": ("COMPOUND", "c_nationkey,c_mktsegment",
                     "COMPOUND SORTKEY(c_nationkey, c_mktsegment): the declared equality filters."),
        "events": ("COMPOUND", "ts",
                   "COMPOUND SORTKEY(ts): ts is the dominant range filter (leading column)."),
        "supplier": ("COMPOUND", "s_nationkey", "COMPOUND SORTKEY(s_nationkey): the declared equality filters."),
        "dim_nation": ("COMPOUND", "",
                       "No SORTKEY recommended -- no declared filter pattern for this table."),
    }
    values = ", ".join(f"('{t}', '{s}', '{c}', '{r}')" for t, (s, c, r) in rows.items())
    return f"sorts(table_name, sortkey_type, sortkey_columns, sort_rationale) as (values {values})"


LAYOUT = f"""
with card as ({_cardinality()}),
ranked as (select *, row_number() over (partition by table_name order by ratio desc, position) r from card),
pick as (select table_name, row_count, case when ratio > 0 then column_name end as column_name,
                case when ratio > 0 then ratio end as ratio
         from ranked where r = 1),
dist as (select table_name, row_count,
                case when table_name like 'dim\\_%' escape '\\' and row_count <= 5000 then 'ALL'
                     when ratio >= 0.05 then 'KEY' else 'EVEN' end as diststyle,
                case when not (table_name like 'dim\\_%' escape '\\' and row_count <= 5000) and ratio >= 0.05
                     then column_name end as distkey,
                case when table_name like 'dim\\_%' escape '\\' and row_count <= 5000
                     then format('DISTSTYLE ALL: only {{:,}} rows -- cheaper to replicate to every node than redistribute.', row_count)
                     when ratio >= 0.05
                     then format('DISTKEY({{}}): {{}}% cardinality ({{:,}}/{{:,}}), dominant join column on this fact''s queries.',
                                 column_name, printf('%.1f', ratio * 100), cast(trunc(ratio * row_count) as bigint), row_count)
                     when ratio < 0.01
                     then format('DISTSTYLE EVEN: best join-key candidate ({{}}) is only {{}}% cardinality -- a DISTKEY here would skew badly onto very few slices.',
                                 column_name, printf('%.1f', ratio * 100))
                     else 'DISTSTYLE EVEN: no join key clears the cardinality bar for a safe DISTKEY.' end as rationale
         from pick),
{_sorts()}"""

_COLUMNS = {
    "orders": (("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", None),
               ("o_totalprice", "DOUBLE PRECISION"), ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", None)),
    "lineitem": (("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
                 ("l_linenumber", "INTEGER"), ("l_quantity", "DOUBLE PRECISION"),
                 ("l_extendedprice", "DOUBLE PRECISION"), ("l_discount", "DOUBLE PRECISION"),
                 ("l_tax", "DOUBLE PRECISION"), ("l_returnflag", None), ("l_linestatus", None),
                 ("l_shipdate", "TIMESTAMP")),
    "customer": (("c_custkey", "BIGINT"), ("c_name", None), ("c_nationkey", "INTEGER"),
                 ("c_acctbal", "DOUBLE PRECISION"), ("c_mktsegment", None)),
    "events": (("event_id", "BIGINT"), ("ts", "TIMESTAMP"), ("user_id", "BIGINT"), ("event_type", None),
               ("value", "DOUBLE PRECISION"), ("props", None)),
    "supplier": (("s_suppkey", "BIGINT"), ("s_name", None), ("s_nationkey", "INTEGER"),
                 ("s_acctbal", "DOUBLE PRECISION")),
    "dim_nation": (("n_nationkey", "INTEGER"), ("n_name", None), ("n_regionkey", "INTEGER")),
}


def _width(column: str, measure: str = "length") -> str:
    return f"'VARCHAR(' || greatest(16, 2 * coalesce(max({measure}({column})), 0)) || ')'"


def _definition(table: str) -> str:
    body = " || ',\n' || ".join(
        f"'    {c} ' || {_width(c) if t is None else repr(t)}" for c, t in _COLUMNS[table]
    )
    return f"select '{table}' as table_name, {body} as body from {table.removeprefix('dim_')}"


DEFINITIONS = f"""{LAYOUT},
bodies as ({' union all '.join(_definition(t) for t in _COLUMNS)})
select table_name, 'CREATE TABLE analytics.' || table_name || ' (\n' || body || '\n)'
       || case when distkey is not null then '\nDISTKEY(' || distkey || ')' else '\nDISTSTYLE ' || diststyle end
       || case when sortkey_columns <> ''
               then '\n' || sortkey_type || ' SORTKEY(' || replace(sortkey_columns, ',', ', ') || ')' else '' end
       || ';\n' as create_table
from bodies join dist using (table_name) join sorts using (table_name)"""

WEEK = (
    "'BATCH-' || user_id || '-' || strftime(date_trunc('week', ts), '%Y-%m-%d') || '/' || "
    "strftime(date_trunc('week', ts)::date + 6, '%Y-%m-%d')"
)
BATCHES = f"""
with lots as (select {WEEK} as batch_id, event_id, user_id, ts, cast(value as decimal(18,2)) as value
              from events where event_type = 'purchase'),
batches as (select batch_id, user_id, sum(value) as total, max(ts) as last_ts from lots group by all),
moves as (select {WEEK} as batch_id, event_id, ts, event_type, cast(value as decimal(18,2)) as value
          from events where event_type <> 'purchase'),
carried as (select batch_id, event_id, ts, event_type,
                   total - case when event_type = 'error' and value > 250 then 1 else 0 end as carried
            from moves left join batches using (batch_id))"""

ORACLES: dict[str, str] = {
    "highwater_batch": f"select {EVENTS}, value, props from events where ts > timestamp '2024-01-15'",
    "highwater_first_load": f"select {EVENTS}, value, props from events where ts is not null",
    "highwater_state": f"""
select 'events' as table_name, {TS.format('max(ts)')} as last_watermark from events
union all
select 'orders', {TS.format('max(o_orderdate)')} from orders
union all
select 'lineitem', {TS.format('max(l_shipdate)')} from lineitem""",
    "upsert_single_key": UPSERTED,
    "upsert_composite_key": """
select conv_id, turn, role, text from conversations where turn <= 1 and role <> 'assistant'
union all
select conv_id, turn, role, case when role = 'assistant' then text || '#' else text end
from conversations where role = 'assistant' or turn > 1""",
    "upsert_replay": UPSERTED,
    "upsert_latest": f"""
select {EVENTS}, cast(cast(value as decimal(18,2)) as double) as value
from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) r from events)
where r = 1""",
    "scd1_dim": """
select row_number() over (order by n_nationkey) as location_key, n_nationkey, n_name, r_name
from nation join region on n_regionkey = r_regionkey""",
    "surrogate_keys": """
select row_number() over (order by o_custkey, o_orderkey) as order_key, o_orderkey, o_custkey from orders""",
    "scd2_initial": _dim("d1"),
    "scd2_classify": f"""{WAVES}
select s.code, s.c_nationkey, s.c_mktsegment,
       case when d.code is null then 'new'
            when s.c_nationkey is distinct from d.c_nationkey or s.c_mktsegment is distinct from d.c_mktsegment
            then 'changed' else 'unchanged' end as change
from s2 s left join d1 d on s.code = d.code""",
    "scd2_second_wave": _dim("d2"),
    "scd2_third_wave": _dim("d3"),
    "scd2_noop": _dim("d3"),
    "scd2_key_coercion": f"""{WAVES}
select 'unchanged' as change, count(*) as n from s1""",
    "scd2_null_tracked": """
with f as (select cast(c_custkey as varchar) code, case when not c_acctbal > 8000 then c_nationkey end n from customer),
s as (select cast(c_custkey as varchar) code, case when not c_acctbal > 9000 then c_nationkey end n from customer)
select s.code, s.n as c_nationkey, case when s.n is distinct from f.n then 'changed' else 'unchanged' end as change
from s join f on s.code = f.code""",
    "scd2_summary": f"""{WAVES}
select 1 as wave, count(*) as n_new_versions, 0 as n_expired from d1
union all select 2, count(*), count(*) filter (where not is_new) from c_d2
union all select 3, count(*), count(*) filter (where not is_new) from c_d3""",
    "scd2_multi_version": f"""{WAVES}
select code, count(*) as n_versions from d3 group by code having count(*) > 1""",
    "effective_dated_dim": f"""with {CERTIFICATES}
select row_number() over (order by p_partkey, certificate_number) as certificate_key, certificate_number, p_partkey,
       strftime(issued_date, '%Y-%m-%d') as issued_date, strftime(expiry_date, '%Y-%m-%d') as expiry_date
from certs""",
    "effective_dated_lookup": f"""with {CERTIFICATES}
select l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate, certificate_number
from lineitem left join certs
  on l_partkey = p_partkey and l_shipdate::date >= issued_date and l_shipdate::date <= expiry_date""",
    "dim_date": """
with b as (select min(d) lo, max(d) hi
           from (select o_orderdate::date d from orders union all select l_shipdate::date from lineitem)),
days as (select unnest(generate_series(lo, hi, interval 1 day))::date as d from b)
select cast(strftime(d, '%Y%m%d') as integer) as date_key, strftime(d, '%Y-%m-%d') as date,
       cast(isodow(d) as integer) as day_of_week, cast(month(d) as integer) as month,
       cast(quarter(d) as integer) as quarter, cast(year(d) as integer) as year
from days""",
    "pit_join": _resolved("d2"),
    "pit_three_versions": _resolved("d3"),
    "pit_deep_history": _resolved("d3"),
    "pit_coverage": f"""
select cast(substr(o_orderdate, 1, 4) as integer) as year, count(*) as n_facts, count(customer_key) as n_resolved
from ({_resolved('d3')}) group by 1""",
    "fact_transactions": f"{SALES} select * from sales",
    "fact_events": f"with {NODES} {MOVES}",
    "fact_summary": f"""{SALES}
select (select count(*) from d2) as dim_customer_rows, (select count(*) from p2) as dim_part_rows,
       (select count(*) from sales) as fact_sales_rows, (select count(*) from events) as fact_moves_rows""",
    "duplicate_candidates": """
select sha256(text) as identity, count(*) as occurrence_count from documents where text is not null group by 1 having count(*) > 1""",
    "duplicate_members": """
select c_nationkey as identity, n as occurrence_count, cast(c_custkey as varchar) as member
from customer join (select c_nationkey k, count(*) n from customer group by 1 having count(*) > 1) on c_nationkey = k""",
    "row_count_recon": f"select * from ({CHECKS}) where check_type = 'row_count'",
    "row_hash": _fold(ORDER_TEXT, "orders"),
    "row_hash_strict": STRICT,
    "silent_change": _checks(("orders", ORDER_TEXT, "orders", TAMPERED)),
    "recon_report": f"select 'run-1' as run_id, * from ({CHECKS})",
    "recon_all_passed": f"select bool_and(passed) as all_passed from ({CHECKS})",
    "key_cardinality": f"select table_name, column_name, row_count, distinct_count, ratio from ({_cardinality()})",
    "dist_advice": f"{LAYOUT} select table_name, row_count, diststyle, distkey, rationale from dist",
    "sort_advice": f"""{LAYOUT}
select table_name, row_count, sortkey_type, sortkey_columns, sort_rationale as rationale
from dist join sorts using (table_name)""",
    "layout_report": f"""{LAYOUT}
select table_name, row_count, diststyle, distkey, sortkey_columns, sortkey_type,
       rationale || ' ' || sort_rationale as rationale,
       case diststyle when 'ALL' then 'broadcast' when 'KEY' then 'partition by hash of ' || distkey
            else 'rebalance evenly' end as spark_action
from dist join sorts using (table_name)""",
    "create_table_text": DEFINITIONS,
    "batch_assembly": f"""{BATCHES}
select batch_id, user_id, cast(total as double) as total_quantity, {TS.format('last_ts')} as last_transaction_at
from batches""",
    "batch_links": f"""{BATCHES}
select batch_id, event_id as transaction_id, cast(value as double) as quantity_allocated, {TS.format('ts')} as updated_at
from lots""",
    "batch_trace": f"""{BATCHES},
ends as (select * from (select *, row_number() over (partition by batch_id order by ts desc, event_id desc) r
                        from carried) where r = 1)
select batch_id, l.event_id as transaction_id, cast(value as double) as quantity_allocated, l.user_id as seller,
       e.event_id, {TS.format('e.ts')} as ts, e.event_type, e.event_id is not null as traced
from lots l left join ends e using (batch_id)""",
    "mass_balance": f"""{BATCHES},
a as (select batch_id, count(*) n, sum(value) s from lots group by 1),
c as (select batch_id, count(*) n, min(carried) lo, max(carried) hi from carried group by 1)
select batch_id, coalesce(a.n, 0) as n_lots, cast(s as double) as allocated, coalesce(c.n, 0) as n_events,
       cast(lo as double) as least_carried, cast(hi as double) as most_carried,
       coalesce(lo = s and hi = s, false) as balanced
from a full join c using (batch_id)""",
}

_PROFILED = {
    "customer": (("c_custkey", "BIGINT"), ("c_name", None), ("c_nationkey", "INTEGER"),
                 ("c_acctbal", "DECIMAL(18,2)"), ("c_mktsegment", None)),
    "part": (("p_partkey", "BIGINT"), ("p_name", None), ("p_brand", None), ("p_type", None),
             ("p_size", "INTEGER"), ("p_retailprice", "DOUBLE PRECISION")),
    "documents": (("doc_id", "BIGINT"), ("text", None), ("lang", None), ("source", None), ("n_chars", "BIGINT")),
}


def _profiles(tables: tuple[str, ...] = tuple(_PROFILED), measure: str = "length") -> str:
    rows = []
    for table in tables:
        columns = _PROFILED[table]
        for i, (column, target) in enumerate(columns, start=1):
            kind = _width(column, measure) if target is None else f"'{target}'"
            source = f" from {table}" if target is None else ""
            rows.append(
                f"select '{table}' as table_name, {i} as position, '{column}' as column_name, "
                f"{kind} as target_type{source}"
            )
    return "\nunion all\n".join(rows)


ORACLES["column_profile"] = _profiles()
ORACLES["column_profile_bytes"] = _profiles(("documents",), "strlen")

ORACLES["full_replace"] = "select n_nationkey, 'new ' || n_name as n_name, n_regionkey from nation"
ORACLES["stored_upsert"] = ORACLES["stored_upsert_by_range"] = ORACLES["stream_upsert"] = UPSERTED
ORACLES["stored_upsert_rebucketed"] = ORACLES["stored_upsert_late"] = UPSERTED
ORACLES["first_load_all_rows"] = "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders where o_orderdate is not null"
ORACLES["stored_upsert_composite"] = ORACLES["upsert_composite_key"]
ORACLES["registry_load_counts"] = """
with n as (select 'nation' as table_name, 'replace' as mode, count(*) as n_rows from nation
           union all select 'supplier', 'replace', count(*) from supplier
           union all select 'customer', 'replace', count(*) from customer
           union all select 'orders', 'incremental', count(*) from orders
           union all select 'events', 'incremental', count(*) from events)
select *, 1 as run from n
union all
select table_name, mode, case when mode = 'replace' then n_rows else 0 end, 2 from n"""
ORACLES["job_fact"] = f"""{WAVES}
select o_orderkey as order_sk, k as customer_key, cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key,
       cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice, o_orderpriority
from orders left join d2 on o_custkey = c_custkey and o_orderdate >= vf and o_orderdate < vt"""
ORACLES["job_fact_incremental"] = f"""{WAVES}
select o_orderkey as order_sk, k as customer_key, cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key,
       cast(cast(o_totalprice as decimal(18,2)) + case when o_orderpriority = '1-URGENT' then 1 else 0 end as double) as o_totalprice,
       o_orderpriority
from orders left join d2 on o_custkey = c_custkey and o_orderdate >= vf and o_orderdate < vt"""
ORACLES["job_wave_counts"] = f"""{WAVES}
select 'run-1' as run_id, 'dim_customer' as table_name, count(*) as n_new_versions, 0 as n_expired from d1
union all select 'run-2', 'dim_customer', count(*), count(*) filter (where not is_new) from c_d2"""
ORACLES["scd2_stored"] = _dim("d3")
ORACLES["scd2_stored_current"] = _dim("d3") + " where cur"
ORACLES["scd1_stable_keys"] = """
select row_number() over (order by c_mktsegment = 'MACHINERY', c_custkey) as customer_key, cast(c_custkey as varchar) as code,
       c_custkey, case when c_acctbal < 0 then (c_nationkey + 1) % 25 else c_nationkey end as c_nationkey, c_mktsegment
from customer"""
ORACLES["stored_upsert_split"] = ORACLES["stream_replay"] = UPSERTED
ORACLES["effective_deep_lookup"] = """
with t as (select s_suppkey, s_suppkey || '-' || n as term, date '1992-01-01' + (n * 97 + s_nationkey * 13)::int as a, (n * n * 3)::int as days
           from (select *, unnest(range(1, s_nationkey + 1)) as n from supplier))
select l_orderkey, l_linenumber, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate, term
from lineitem left join t on l_suppkey = s_suppkey and l_shipdate::date >= a and l_shipdate::date <= a + days"""
ORACLES["sketch_cardinality"] = """
select 'events' as table_name, c as column_name, n as row_count, d as distinct_count, true as within_error
from (select count(*) n, count(distinct user_id) u, count(distinct event_type) t, count(distinct event_id) e from events),
lateral (values ('user_id', u), ('event_type', t), ('event_id', e)) v(c, d)"""
ORACLES["hot_key_advice"] = """
with o as (select *, case when o_orderpriority = '1-URGENT' then 0 else o_custkey end as c from orders),
t as (select 'by_order' as table_name, 'o_orderkey' as k, cast(o_orderkey as varchar) as v from o
      union all select 'by_customer', 'o_custkey', cast(c as varchar) from o
      union all select 'by_priority', 'o_orderpriority', o_orderpriority from o),
s as (select table_name, k, count(*) as n, count(distinct v) as d from t group by all),
h as (select table_name, v, count(*) as hits, row_number() over (partition by table_name order by count(*) desc, v) as r from t group by table_name, v)
select table_name, n as row_count, case when d / n >= 0.05 then 'KEY' else 'EVEN' end as diststyle, case when d / n >= 0.05 then k end as distkey,
       case when d / n >= 0.05 and hits >= 0.1 * n then v end as hot_value, case when d / n >= 0.05 and hits >= 0.1 * n then hits end as hot_rows,
       case when d / n >= 0.05 and hits >= 0.1 * n then hits / n end as hot_share, case when d / n >= 0.05 then hits < 0.1 * n end as safe,
       case when d / n >= 0.05 and hits >= 0.1 * n then 'salt ' || k || ' before shuffles' end as hot_action
from s join h using (table_name) where r = 1"""
CHAINS = f"""
with recursive e as (select {WEEK} as batch, event_id as move, event_type, event_id * 7919 % 101 as t,
    lag(event_id * 7919 % 101) over (partition by {WEEK} order by ts, event_id) as f from events),
m as (select * from e where event_type <> 'error'),
arr as (select batch, t, count(*) as n, min(move) as first from m group by all),
dep as (select batch, f, count(*) as n from m group by all),
p as (select m.batch, move, case when arr.n = 1 then arr.first end as follows,
             case when m.f is null then 'start' when arr.n is null then 'gap' when arr.n > 1 then 'merge' else 'link' end as kind,
             coalesce(dep.n, 0) as n_next
      from m left join arr on m.batch = arr.batch and m.f = arr.t left join dep on m.batch = dep.batch and m.t = dep.f),
walk as (select batch, move, move as first, 0::bigint as place from p where follows is null
         union all select p.batch, p.move, walk.first, place + 1 from p join walk on p.batch = walk.batch and p.follows = walk.move),
found as (select p.*, walk.first, place, walk.first is null as in_cycle from p left join walk using (batch, move))"""
ORACLES["custody_chain"] = f"{CHAINS} select * from found"
ORACLES["custody_report"] = f"""{CHAINS}
select batch, count(*) as n_moves, count(*) filter (where place = 0) as n_chains, count(*) filter (where kind = 'gap') as n_gaps,
       count(*) filter (where kind = 'merge') as n_merges, count(*) filter (where n_next > 1) as n_forks,
       count(*) filter (where in_cycle) as n_in_cycles, coalesce(max(place), -1) + 1 as longest
from found group by batch"""
ORACLES["recon_diff_rows"] = """
select o_orderkey, 'missing' as difference from orders where o_orderstatus = 'P'
union all select -o_orderkey - 1, 'extra' from orders where o_orderstatus = 'P'
union all select o_orderkey, 'changed' from orders where o_orderkey = 1 and o_orderstatus <> 'P'"""
ORACLES["recon_diff_turns"] = """
select conv_id, turn, case when turn > 3 then 'missing' else 'changed' end as difference
from conversations where turn > 3 or role = 'assistant'"""
ORACLES["repair_load"] = """
with old as (select * from orders where o_orderdate < timestamp '1998-01-01'),
c as (select count(*) filter (where o_orderstatus <> 'P' and o_orderpriority = '1-URGENT') as changed,
             (select count(*) from orders where o_orderdate >= timestamp '1998-01-01' and o_orderstatus <> 'P') as missing,
             count(*) filter (where o_orderstatus = 'P') as extra from old)
select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) + case when o_orderpriority = '1-URGENT' then 1 else 0 end as double) as o_totalprice,
       strftime(o_orderdate + interval 10 year, '%Y-%m-%d %H:%M:%S.%f') as updated_at, changed, missing, extra
from orders, c where o_orderstatus <> 'P'"""
ORACLES["audit_log"] = """
select run_id, step, status, n_checks, n_checks as n_passed
from (values ('run-1', 'SUCCESS', 10), ('run-2', 'DRY_RUN', null)) r(run_id, status, n_checks), (values ('extract'), ('transform'), ('validate')) s(step)"""
ORACLES["export_roundtrip"] = """
select table_name, check_type, true as passed
from (values ('orders'), ('lineitem')) t(table_name), (values ('row_count'), ('row_hash')) c(check_type)"""
