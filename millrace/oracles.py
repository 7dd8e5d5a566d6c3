"""For each registered query, what it must give, as DuckDB SQL over the same tables."""

from __future__ import annotations

from millrace import fixtures as fx
from millrace.operators import logrules

# Where the correctness check keeps its tables; only the file manifest, which
# reads the files as files, needs to know.
CHECKED_DIR = "/root/testdata/sf0.01"

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _one_per_key(source: str, columns: list[str], key: list[str], newest: str = "") -> str:
    """Rows of `source` that come first in their key's order."""
    rest = [f"{c} asc nulls first" for c in columns if c not in key and c != newest]
    order = ([f"{newest} desc nulls last"] if newest else []) + rest
    return (
        f"select {', '.join(columns)} from {source} "
        f"qualify row_number() over (partition by {', '.join(key)} "
        f"order by {', '.join(order)}) = 1"
    )


_LINE_COLUMNS = fx.LINEITEM.schema.names
_LINE_KEY = list(fx.LINEITEM.primary_key)
_DEDUPED_LINES = _one_per_key("lineitem", _LINE_COLUMNS, _LINE_KEY)

_ODD_NUMBERS = """
    select l_orderkey, l_linenumber,
      case when l_linenumber = 1 then '  ' || l_orderkey || ' '
           when l_linenumber = 2 then l_quantity::varchar
           when l_linenumber = 3 then '+' || l_partkey
           when l_linenumber = 4 then '-' || l_suppkey || '.'
           when l_linenumber = 5 then l_orderkey || 'e3'
           when l_linenumber = 6 then '.' || l_partkey
           when l_returnflag = 'A' then l_returnflag || l_partkey
           when l_returnflag = 'N' then l_suppkey || '0000000000' end as t
    from lineitem
"""
# A sign, a leading zero for the digits missing in '.5', then the digits.
_AS_INT = r"""
    case when regexp_full_match(t, '[\x00-\x20]*[+-]?(\d+(\.\d*)?|\.\d*)[\x00-\x20]*')
         then try_cast(regexp_extract(t, '^[\x00-\x20]*([+-]?)', 1) || '0'
                || regexp_extract(t, '^[\x00-\x20]*[+-]?(\d*)', 1) as integer) end
"""

_GAPPY_ORDERS = """
    select case when not (o_orderpriority = '1-URGENT' and o_orderstatus = 'P')
                then o_orderkey end as o_orderkey,
      o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus, o_orderdate,
      nullif(o_orderpriority, '1-URGENT') as o_orderpriority
    from orders
"""

_DOCUMENT_LOG = """
    select source as dataset_name,
      case when lang <> 'de' then 'doc' || doc_id end as source_file_name,
      n_chars as file_size_bytes, n_chars - 60 as row_count,
      length(lang) - case when lang = 'es' then 2 else 0 end as column_count,
      case when n_chars < 100 then date '2026-01-31' end as load_date,
      timestamp '2026-01-31 12:00:00' as ingestion_timestamp,
      case when lang <> 'fr' then md5(text) end as checksum,
      source || '_' || doc_id as run_id
    from documents
"""
_EVENT_LOG = """
    select event_type || '_' || event_id as run_id, 'user' || user_id as dataset_name,
      ts as start_time, floor(value - 1)::integer as duration_seconds,
      case when event_type in ('view', 'click') then 'SUCCESS'
           when event_type in ('error', 'signup') then 'FAILED'
           else upper(event_type) end as status,
      case when value < 150 then props end as file_name,
      case when event_type = 'error' then props end as error_message
    from events
"""


def _broken_rules(log: str, required: tuple[str, ...], rules: dict[str, str]) -> str:
    """Union of one query per rule over `log`."""
    conditions = {f"{c}_required": f"{c} is null" for c in required} | rules
    parts = [
        f"select run_id, '{rule}' as rule from log where {bad}" for rule, bad in conditions.items()
    ]
    return f"with log as ({log}) " + " union all ".join(parts)


def _profile(name: str) -> str:
    names = f"(select string_agg(column_name, ',' order by ordinal_position) from columns_of where table_name = '{name}')"
    count = f"(select count(*)::integer from columns_of where table_name = '{name}')"
    return (
        f"select '{name}' as dataset, count(*) as row_count, "
        f"{count} as column_count, {names} as column_names from {name}"
    )


_COLUMNS_OF = (
    "with columns_of as (select view_name as table_name, c.column_name, c.column_index as "
    "ordinal_position from duckdb_views() v join duckdb_columns() c on c.table_name = v.view_name)"
)


def _profiles() -> str:
    return f"{_COLUMNS_OF} " + " union all ".join(_profile(t) for t in fx.TABLES)


def _landed(select: str) -> str:
    return " union all ".join(
        select.format(name=name, columns=",".join(c.schema.names), width=len(c.schema.names))
        for name, c in fx.RELATIONAL.items()
    )


_MERGED_ORDERS = f"""
    select {_ORDERS.replace('o_totalprice', "case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice")}
    from orders
    union all
    select {_ORDERS.replace('o_orderkey', '-o_orderkey - 1 as o_orderkey')}
    from orders where o_orderstatus = 'P'
"""

def _checksums() -> str:
    """Size and MD5 of each table's columns as a CSV file in key order."""
    parts = []
    for name, columns in fx.PLAIN_COLUMNS.items():
        line = " || ',' || ".join(columns)
        text = f"'{','.join(columns)}' || chr(10) || string_agg({line} || chr(10), '' order by {columns[0]})"
        parts.append(
            f"select '{name}' as dataset_name, strlen(t) as file_size_bytes, md5(t) as checksum "
            f"from (select {text} as t from {name})"
        )
    return " union all ".join(parts)


def _digests() -> str:
    """Rows and order-free digest of each table: word-wise sums of the MD5s of its rows' text."""
    words = [
        f"sum(('0x' || substr(m, {1 + 8 * i}, 8))::bigint) % 4294967296" for i in range(4)
    ]
    digest = " || ".join(f"printf('%08x', ({w})::bigint)" for w in words)
    parts = []
    for name, columns in fx.PLAIN_COLUMNS.items():
        line = " || ',' || ".join(columns)
        parts.append(f"select '{name}' as dataset, md5({line}) as m from {name}")
    rows = " union all ".join(parts)
    return (
        f"with found as (select dataset, count(*) as row_count, {digest} as content_digest "
        f"from ({rows}) group by dataset) select * from found "
        "union all select 'landed ' || dataset, row_count, content_digest from found"
    )


_KEPT_ORDERS = """
    select o_orderpriority, strlen(t) as file_size_bytes, md5(t) as checksum from (
      select o_orderpriority, 'o_orderkey,o_custkey,o_orderstatus' || chr(10) || string_agg(
        o_orderkey || ',' || o_custkey || ',' || o_orderstatus || chr(10), '' order by o_orderkey) as t
      from orders group by o_orderpriority)
"""

ORACLES: dict[str, str] = {
    "scan_parquet": f"select {_ORDERS} from orders",
    "scan_csv": f"select {', '.join(_LINE_COLUMNS)} from lineitem",
    "csv_quoted_text": "select doc_id, text, lang, source, n_chars from documents",
    "csv_peek": "select * from customer order by c_custkey limit 5",
    "replay_partition": f"select {_ORDERS} from orders where year(o_orderdate) in (1996, 1998)",
    "latest_snapshot": f"select {_ORDERS} from orders "
    "where year(o_orderdate) = (select max(year(o_orderdate)) from orders)",
    "file_manifest": "select parse_filename(filename) as file_name, size as file_size_bytes, "
    f"md5(content) as checksum from read_blob('{CHECKED_DIR}/*.parquet')",
    "source_validation": "select n_nationkey, n_name, n_regionkey, "
    "exists (select 1 from supplier where s_nationkey = n_nationkey and s_acctbal < 0) as valid "
    "from nation",
    "block_checksums": "select parse_filename(filename) as file_name, size as file_size_bytes, "
    "(size - 1) // 262144 + 1 as blocks, md5(array_to_string(list_transform("
    "range(0, (size - 1) // 262144 + 1), "
    "lambda i: md5(unhex(substr(hex(content), i * 524288 + 1, 524288)))), '')) as block_checksum "
    f"from read_blob('{CHECKED_DIR}/*.parquet')",
    "content_digests": _digests(),
    "landed_files": _KEPT_ORDERS,
    "packed_log": _landed(
        "select '{name}_20260131235958' as run_id, '{name}' as dataset_name, 'SUCCESS' as status, "
        "count(*) as records_processed, '{name}.csv' as file_name from {name}"
    )
    + " union all select 'absent_20260131235958', 'absent', 'FAILED', 0, 'absent.csv'",
    "source_verdicts": "select n_nationkey, case when exists (select 1 from supplier "
    "where s_nationkey = n_nationkey and s_acctbal < 0) then 'ok' "
    "when n_regionkey = 1 then 'empty' else 'missing' end as verdict from nation",
    "csv_records_in_ranges": "select doc_id, text, lang, source, n_chars from documents",
    "landed_nested": "select * from supplier",
    "landed_inch_marks": "select * replace (p_name || ' ' || p_size || '\" wide' as p_name) from part",
    "landed_multiline": "select doc_id, 'say \"\"' || lang || '\"' || chr(10) || text "
    "|| chr(13) || chr(10) as text, lang, source, n_chars from documents",
    "incremental_unique": "select *, ts::date as load_date, event_type = 'error' and ts < "
    "(select max(ts) from events where event_type <> 'error') - interval 1 day as late from events",
    "incremental_gate_with_references": f"select {_ORDERS} from orders",
    "incremental_orphans": "select o_orderkey, case when exists (select 1 from customer "
    "where c_custkey = o_custkey and (c_acctbal >= 0 or c_mktsegment = 'BUILDING')) "
    "then 'published' else 'waiting' end as state from orders",
    "table_profile": _profiles(),
    "enforce_schema": "select l_orderkey::integer as l_orderkey, l_linenumber, "
    "trunc(l_quantity)::integer as l_quantity, "
    "trunc(l_extendedprice)::integer as l_extendedprice, "
    "l_discount::varchar as l_discount, l_shipdate::date as l_shipdate, l_returnflag "
    "from lineitem",
    "lenient_casts": f"select l_orderkey, l_linenumber, t, {_AS_INT} as as_int, "
    f"try_cast(t as double) as as_double from ({_ODD_NUMBERS})",
    "cast_failures": "select 'l_orderkey' as \"column\", 0::bigint as lost_values union all "
    f"select 't', count(*) filter (t is not null and {_AS_INT} is null) from ({_ODD_NUMBERS})",
    "trim_strings": "select c_custkey, trim('  ' || c_name || ' ', ' ') as c_name, c_nationkey, "
    "c_acctbal, trim(chr(9) || c_mktsegment || chr(160) || '  ', ' ') as c_mktsegment from customer",
    "standard_names": "select c_custkey as customer_key, c_name, c_nationkey, "
    'c_acctbal as "acct.bal", c_mktsegment as mkt__segment from customer',
    "dedup_by_key": _DEDUPED_LINES,
    "dedup_newest": _one_per_key("orders", fx.ORDERS.schema.names, ["o_custkey"], "o_orderdate"),
    "transform_chain": "select *, l_extendedprice * (1 - l_discount) as net_price "
    f"from ({_DEDUPED_LINES})",
    "row_count": "select count(*) as row_count from lineitem",
    "null_profile": "select "
    + ", ".join(
        f"count(*) filter ({c} is null) as {c}"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    )
    + f" from ({_GAPPY_ORDERS})",
    "duplicate_keys": "select l_orderkey, l_linenumber, count(*) as copies from lineitem "
    "group by all having count(*) > 1",
    "surplus_rows": "select sum(n)::bigint as row_count, "
    "count(*) filter (n > 1) as duplicate_keys, sum(n - 1)::bigint as surplus_rows from "
    "(select count(*) as n from lineitem group by l_orderkey, l_linenumber)",
    "quality_report": f"""
        with g as ({_GAPPY_ORDERS}), n as (select count(*) as total_records from g),
        checks as (
          select 'required_present' as "check", 'o_comment' as "column", 1::bigint as violations
          union all select 'key_present', 'o_clerk', 1
          union all select 'required_not_null', 'o_orderstatus',
            count(*) filter (o_orderstatus is null) from g
          union all select 'required_not_null', 'o_orderpriority',
            count(*) filter (o_orderpriority is null) from g
          union all select 'required_not_null', 'o_custkey',
            count(*) filter (o_custkey is null) from g
          union all select 'key_not_null', 'o_orderkey',
            count(*) filter (o_orderkey is null) from g
          union all select 'key_unique', 'o_orderkey,o_custkey', count(*) from
            (select 1 from g group by o_orderkey, o_custkey having count(*) > 1)
        )
        select 'orders' as dataset, "check", "column", violations, total_records,
          violations = 0 as passed
        from checks, n
    """,
    "quality_gate": _DEDUPED_LINES,
    "orphan_rows": f"select {_ORDERS} from orders "
    "where not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
    "orphan_keys": "select l_partkey, count(*) as rows from lineitem where not exists "
    "(select 1 from part where p_partkey = l_partkey and p_size > 25) group by l_partkey",
    "reference_report": """
        with l as (
          select case when l_returnflag = 'R' then -l_orderkey - 1 else l_orderkey end as o,
            l_partkey as p, case when l_linestatus = 'O' then l_suppkey end as s
          from lineitem)
        select 'lineitem' as dataset, 'l_orderkey' as reference, 'orders' as parent,
          count(distinct o) as orphan_keys, count(*) as orphan_rows
        from l where o not in (select o_orderkey from orders)
        union all
        select 'lineitem', 'l_partkey', 'part', count(distinct p), count(*)
        from l where p not in (select p_partkey from part)
        union all
        select 'lineitem', 'l_suppkey', 'supplier', count(distinct s), count(*)
        from l where s not in (select s_suppkey from supplier)
    """,
    "landing_metadata": _landed(
        "select '{name}' as dataset_name, '{name}.csv' as source_file_name, "
        "count(*) as row_count, {width} as column_count, '{columns}' as column_names, "
        "date '2026-01-31' as load_date, "
        "epoch(timestamp '2026-01-31 23:59:58')::bigint as ingested_at, "
        "'{name}_20260131235958' as run_id from {name}"
    ),
    "landing_audit": _landed(
        "select '{name}_20260131235958' as run_id, '{name}' as dataset_name, "
        "0 as duration_seconds, 'SUCCESS' as status, count(*) as records_processed, "
        "'{name}.csv' as file_name, false as has_message from {name}"
    )
    + " union all select 'absent_20260131235958', 'absent', 0, 'FAILED', 0, 'absent.csv', true",
    "landed_rows": "select doc_id, text, lang, source, n_chars, date '2026-01-31' as load_date "
    "from documents",
    "run_records": "select event_id, event_type || '_' || strftime(ts, '%Y%m%d%H%M%S') as run_id, "
    "ts::date as load_date, trunc(value)::integer as duration_seconds from events",
    "metadata_violations": _broken_rules(
        _DOCUMENT_LOG,
        logrules.METADATA_REQUIRED,
        {
            "row_count_not_negative": "row_count < 0",
            "column_count_positive": "coalesce(column_count, 0) <= 0",
            "file_size_positive": "coalesce(file_size_bytes, 0) <= 0",
            "checksum_required": "checksum is null",
            "dataset_known": "dataset_name not in ('src0', 'src1', 'src2', 'src3')",
        },
    ),
    "audit_violations": _broken_rules(
        _EVENT_LOG,
        logrules.AUDIT_REQUIRED,
        {
            "status_known": "status not in ('SUCCESS', 'FAILED')",
            "duration_not_negative": "duration_seconds < 0",
            "failure_explained": "status = 'FAILED' and error_message is null",
        },
    ),
    "run_totals": "select count(*) as total, count(*) filter (status = 'SUCCESS') as passed, "
    f"count(*) filter (status = 'FAILED') as failed from ({_EVENT_LOG})",
    "run_outcomes": "select status, dataset_name, count(*) as attempts "
    f"from ({_EVENT_LOG}) group by all",
    "duplicate_content": "select md5(text) as checksum, count(*) as loads from documents "
    "group by all having count(*) > 1",
    "already_loaded": "select doc_id, source, md5(text) as checksum from documents "
    "where source >= 'src15' and md5(text) in "
    "(select md5(text) from documents where source < 'src15')",
    "combined_logs": "select run_id, dataset_name, row_count, null::varchar as status "
    f"from ({_DOCUMENT_LOG}) union all "
    f"select run_id, dataset_name, null, status from ({_EVENT_LOG})",
    "publish_overwrite": f"select {_ORDERS} from orders where o_orderpriority <> '2-HIGH' "
    f"union all select {_ORDERS.replace('o_totalprice', '0.0::double')} from orders "
    "where o_orderpriority = '2-HIGH' and o_orderstatus <> 'F'",
    "upsert_merge": _MERGED_ORDERS,
    "upsert_partitions": _MERGED_ORDERS,
    "silver_job": _one_per_key(
        "(select * , 1 as load from lineitem union all "
        "select * replace (l_tax + 1 as l_tax), 2 from lineitem where l_linestatus = 'O')",
        _LINE_COLUMNS,
        _LINE_KEY,
        "load",
    ),
    "incremental_landing": "select event_id, ts, user_id, event_type, value, props, "
    "ts::date as load_date from events",
    "incremental_merge": _one_per_key("events", fx.EVENTS.schema.names, ["user_id"], "ts"),
    "silver_backfill": _one_per_key("events", fx.EVENTS.schema.names, ["user_id"], "ts"),
    "gate_with_references": f"select {', '.join(fx.ORDERS.schema.names)} from orders",
    "landing_checksums": _checksums(),
    "upsert_moved_rows": """
        select * replace (if(o_orderstatus = 'P', 'F', o_orderstatus) as o_orderstatus) from orders
    """,
    "silver_republished": """
        select * replace (if(o_orderstatus = 'P', 'O', o_orderstatus) as o_orderstatus) from orders
    """,
}
