"""DuckDB SQL equivalents of the registered queries (same column names)."""

from __future__ import annotations

CUT = "(select (count(*) * 8) // 10 from events)"
WM = f"(select max(ts) - interval '600' second from events where event_id < {CUT})"

LOG_WM = "(select max(ts) - interval '600' second from events where event_type = 'error')"
RUN_TIME = "cast('2024-01-15 05:30:00' as timestamp) as run_time"  # 12:30 UTC in the audit zone


def _scrub(c: str) -> str:
    return f"regexp_replace(cast({c} as varchar), 'null', '', 'g') as {c}"


def _text(cols: list[str]) -> str:
    return ", ".join(f"cast({c} as varchar) as {c}" for c in cols)


ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

ORDERS_YM = "(select *, strftime(o_orderdate, '%Y%m') as o_yearmonth from orders)"

BOOL_FIXTURE = """(select cast(doc_id as varchar) as doc_id,
  case when quality = 1 then 'true' else 'false' end as quality_flag,
  case when toxic = 1 then 'true' else '' end as toxic_flag,
  case when quality = 1 then 'true' else 'maybe' end as mixed_text,
  case when toxic = 1 then '' end as blank_text
 from labels)"""

BOOL_COLS = ["doc_id", "quality_flag", "toxic_flag", "mixed_text", "blank_text"]


def _is_bool(c: str) -> str:
    return (f"(count_if({c} in ('true', 'false')) > 0 "
            f"and coalesce(bool_and({c} in ('true', 'false', '')), true)) as {c}")


def _encode(c: str) -> str:
    return f"case when {c} = 'false' then 0 when {c} = '' then 0 else 1 end as {c}"


ORDERS_CHANGE_COMPOSITE = f"""
  tgt as (select * from {ORDERS_YM}),
  src as (
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate,
           '1-URGENT' as o_orderpriority, o_yearmonth from tgt where o_orderstatus = 'O'
    union all
    select o_orderkey + 1000000000000 as o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority, o_yearmonth from tgt where o_orderstatus = 'P')"""

ORDERS_CHANGE_MOVED = f"""
  tgt as (select * from {ORDERS_YM}),
  moved as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice,
                   o_orderdate + interval 40 day as o_orderdate, '1-URGENT' as o_orderpriority
            from tgt where o_orderstatus = 'O'),
  src as (
    select *, strftime(o_orderdate, '%Y%m') as o_yearmonth from moved
    union all
    select o_orderkey + 1000000000000 as o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority, o_yearmonth from tgt where o_orderstatus = 'P')"""

ORDERS_ALTERED = """(
  select o_orderkey, o_custkey, o_orderstatus,
         case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as o_totalprice,
         o_orderdate, o_orderpriority
  from orders where o_orderstatus <> 'P'
  union all
  select o_orderkey + 1000000000000 as o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority
  from orders where o_orderstatus = 'P')"""

FLAGSHIP = f"""
  tgt as (select * from events where event_id < {CUT}),
  chg as (select event_id, ts, user_id, event_type, value * 2 as value, props from events where ts > {WM}),
  merged as (select * from chg union all
             select * from tgt where not exists (select 1 from chg where chg.event_id = tgt.event_id))"""

ROW_NUMBER = "(select *, row_number() over (order by o_orderkey desc) as row_no from orders)"

QA_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
QA_CHANGED = "concat_ws(',', " + ", ".join(
    f"case when a.{c} is distinct from b.{c} then '{c}' end" for c in QA_VALUES) + ")"

FULL_SYNC = (
    "select " + ", ".join(_scrub(c) for c in EVENTS)
    + ", case when event_type = 'error' then '1' else '0' end as is_deleted, "
    "strftime(ts, '%Y%m') as ts_yearmonth from events")

ORACLES: dict[str, str] = {
    "scan_all": "select * from orders",
    "watermark_lookup": f"select {LOG_WM} as watermark",
    "watermark_literal": f"select strftime({LOG_WM}, '%Y-%m-%dT%H:%M:%SZ') as watermark_text",
    "incremental_extract": f"select * from events where ts > {WM}",
    "extract_with_deleted": (f"select *, case when event_type = 'error' then 'true' else 'false' end as is_deleted "
                             f"from events where ts > {WM}"),
    "empty_short_circuit": (f"select {_scrub('event_id')}, {_scrub('event_type')}, strftime(ts, '%Y%m') as ts_yearmonth, "
                            "'empty' as second_run, 1 as watermark_rows, 1 as control_rows from events"),
    "extract_text_watermark": (
        "select event_id, case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' "
        "else strftime(ts - interval 7 hour, '%Y-%m-%dT%H:%M:%S.%f') || '-07:00' end as modified "
        f"from events where ts > {WM}"),
    "null_token_scrub": (
        "with f as (select c_custkey, c_name, c_name || 'null' as c_name_tail, "
        "'null' || c_mktsegment || 'nullify' as c_segment_both, 'NULL' || c_mktsegment as c_segment_upper, "
        "c_nationkey from customer) select "
        + ", ".join(_scrub(c) for c in ["c_custkey", "c_name", "c_name_tail", "c_segment_both",
                                         "c_segment_upper", "c_nationkey"]) + " from f"),
    "bool_detect": (
        f"with a as (select {', '.join(_is_bool(c) for c in BOOL_COLS)} from {BOOL_FIXTURE}) "
        + " union all ".join(f"select '{c}' as column_name, {c} as is_boolean from a" for c in BOOL_COLS)),
    "bool_encode": (f"select doc_id, {_encode('quality_flag')}, {_encode('toxic_flag')}, mixed_text, blank_text "
                    f"from {BOOL_FIXTURE}"),
    "year_month_key": "select o_orderkey, o_orderdate, strftime(o_orderdate, '%Y%m') as o_yearmonth from orders",
    "cast_all_string": f"select {_text(ORDERS)} from orders",
    "cast_all_string_lineitem": f"select {_text(LINEITEM)} from lineitem",
    "retype_timestamps": (
        f"select {_text([c for c in ORDERS if c != 'o_orderdate'])}, "
        "try_cast(cast(o_orderdate as varchar) as timestamp) as o_orderdate from orders"),
    "rename_for_sink": ("select c_custkey as customer_key, c_name, c_nationkey, c_acctbal as account_balance, "
                        "c_mktsegment as market_segment from customer"),
    "stage_overwrite": f"select * from {ORDERS_YM}",
    "compact_table": f"select * from {ORDERS_YM}",
    "upsert_composite": (
        f"with {ORDERS_CHANGE_COMPOSITE} select * from src union all select * from tgt t where not exists "
        "(select 1 from src s where s.o_orderkey = t.o_orderkey and s.o_yearmonth = t.o_yearmonth)"),
    "upsert_single_key": (
        f"with {ORDERS_CHANGE_MOVED} select * from src union all select * from tgt t where not exists "
        "(select 1 from src s where s.o_orderkey = t.o_orderkey)"),
    "duplicate_source_keys": ("select l_orderkey, l_linenumber, count(*) as n_rows from lineitem "
                              "group by l_orderkey, l_linenumber having count(*) > 1"),
    "dedupe_source_keys": (
        "select " + ", ".join(LINEITEM) + " from (select *, row_number() over (partition by l_orderkey, "
        "l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, "
        "l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) as rn "
        "from lineitem) where rn = 1"),
    "soft_delete_propagation": (
        f"with tgt as (select event_id, event_type, 0 as is_deleted from events where event_id < {CUT}), "
        f"chg as (select event_id, event_type, case when event_type = 'error' then 1 else 0 end as is_deleted "
        f"from events where ts > {WM}) "
        "select * from chg union all select * from tgt where not exists "
        "(select 1 from chg where chg.event_id = tgt.event_id)"),
    "row_number_desc": f"select * from {ROW_NUMBER}",
    "batch_slices": (f"select (row_no - 1) // 1000 as batch_id, count(*) as n_rows, min(row_no) as first_row, "
                     f"max(row_no) as last_row from {ROW_NUMBER} group by 1"),
    "qa_compare": (
        f"with b as {ORDERS_ALTERED}, j as (select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, "
        "a.o_orderkey is null as only_b, b.o_orderkey is null as only_a, "
        f"{QA_CHANGED} as changed from orders a full outer join b on a.o_orderkey = b.o_orderkey) "
        "select o_orderkey, case when only_b then 'only_b' when only_a then 'only_a' else 'changed' end as status, "
        "case when only_a or only_b then null else changed end as changed_columns "
        "from j where only_a or only_b or changed <> ''"),
    "qa_union": (f"select 'left' as instance, * from orders union all "
                 f"select 'right' as instance, * from {ORDERS_ALTERED}"),
    "qa_id_list": ("with ids as (select unnest(range(1, 3000, 7)) as id) "
                   "select 'left' as instance, * from orders where o_orderkey in (select id from ids) union all "
                   f"select 'right' as instance, * from {ORDERS_ALTERED} where o_orderkey in (select id from ids)"),
    "slice_rows": f"select * from {ROW_NUMBER} where row_no > 1000 and row_no <= 2000",
    "upsert_null_partition": (
        "select *, case when o_orderstatus <> 'F' then strftime(o_orderdate, '%Y%m') end as part from orders "
        "union all select *, null as part from orders where o_orderstatus = 'P'"),
    "upsert_subset_columns": (
        f"with tgt as (select * from {ORDERS_YM}) "
        "select o_orderkey, o_custkey, o_orderstatus, case when o_orderstatus = 'O' then o_totalprice + 1 "
        "else o_totalprice end as o_totalprice, o_orderdate, o_orderpriority, o_yearmonth from tgt union all "
        "select o_orderkey + 1000000000000, null, null, o_totalprice, null, null, o_yearmonth from tgt "
        "where o_orderstatus = 'P'"),
    "utc_to_zone": ("select event_id, ts, (ts at time zone 'UTC') at time zone 'MST7MDT' as ts_local "
                    "from events"),
    "audit_watermark_row": f"with {FLAGSHIP} select 'events' as table_name, max(ts) as last_modified, "
                            f"{RUN_TIME} from merged",
    "control_log_row": (
        f"with chg as (select * from events where ts > {WM}), "
        f"upd as (select count(*) as n from chg where event_id < {CUT}) "
        f"select 'events' as table_name, max(ts) as max_date_check, {RUN_TIME}, count(*) as merge_count, "
        "count(*) as source_success_rows, count(*) - (select n from upd) as inserted_rows, "
        "(select n from upd) as updated_rows from chg"),
    "flagship_sync": f"with {FLAGSHIP} select * from merged",
    "full_sync": FULL_SYNC,
    "stream_sync": FULL_SYNC,
}

# The same results by other mechanisms.
ORACLES.update({
    "connector_scan": ORACLES["extract_with_deleted"],
    "upsert_key_index": ORACLES["upsert_single_key"],
    "upsert_bucketed": ORACLES["upsert_composite"],
    "publish_switch": ORACLES["upsert_composite"],
    "merge_generated": ORACLES["upsert_composite"],
    "qa_digest": ORACLES["qa_compare"],
    "compact_bins": ORACLES["compact_table"],
    "sliced_sink": f"select *, (row_no - 1) // 1000 as slice from {ROW_NUMBER}",
    "stream_lookback": "select * from events",
})
