"""Registered queries: one builder per operator, each with a DuckDB oracle.

Every builder takes ``(spark, sf_dir)``, reads the whole driver tables and
returns a DataFrame.  Fixtures are derived from those tables by rules that
scale with them:

* events: the rows below 80 % of the event count stand for what an earlier
  run loaded (event ids rise with ``ts``); ``event_type = 'error'`` stands
  for the soft-delete flag.
* orders: ``o_orderstatus = 'O'`` rows are the changed records, ``'P'``
  rows re-keyed past every existing key are the new records.

Builders that write tables do so below a fresh folder of the shared
checkpoint location and return the table read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SyncConfig
from tidemark.functions.columns import col, utc_to_zone
from tidemark.operators.audit import control_row, watermark_row
from tidemark.operators.clean import (
    add_year_month,
    bool_detect,
    cast_all_string,
    encode_booleans,
    null_token_scrub,
    rename_for_sink,
    retype_timestamps,
)
from tidemark.operators.digest import qa_diff_tree
from tidemark.operators.number import batch_summary, row_number_ranged, slice_ids, slice_rows
from tidemark.operators.qa import qa_diff, qa_union
from tidemark.operators.upsert import dedupe_latest, duplicate_keys, merge_counts, upsert_frames
from tidemark.plans.sync import CONTROL_LOG_SCHEMA, LakePaths, read_log, sync
from tidemark.session import scratch_path
from tidemark.sinks.bucketed import create_bucketed, upsert_bucketed
from tidemark.sinks.catalog import create_table
from tidemark.sinks.compact import compact_bins
from tidemark.sinks.generated import merge_overwrite_sql, run_generated
from tidemark.sinks.slices import publish_slices, read_slices
from tidemark.sinks.switch import publish_overwrite, publish_upsert
from tidemark.sinks.table import compact_table, stage_overwrite, upsert_table, write_partitioned
from tidemark.sources.connector import connector_scan, write_pages
from tidemark.sources.extract import incremental_extract
from tidemark.sources.tables import read_partitioned, read_table, scan_all
from tidemark.sources.watermark import read_watermark, watermark_literal, watermark_lookup

# Fixed values of the fixtures (also used verbatim in the oracle SQL below).
LOOKBACK_SECONDS = 600           # watermark look-back
NEW_KEY_OFFSET = 1_000_000_000_000  # new order keys = existing key + offset
SLICE_SIZE = 1000                # rows per publish slice in batch_slices
ZONE = "MST7MDT"                 # zone of the run time / utc_to_zone
RUN_AT = "2024-01-15 12:30:00"   # UTC run time of the audit queries
LOG_NAME = "error"               # event type that stands for one table's log name


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- events fixtures

def _events_cut(ev: DataFrame) -> int:
    """Event ids below this were loaded by the earlier run (80 % of the rows)."""
    return ev.count() * 8 // 10


def _events_log(ev: DataFrame, cut: int) -> DataFrame:
    return ev.where(F.col("event_id") < cut).select(
        F.lit("events").alias("table_name"), F.col("ts").alias("last_modified"))


def _events_extract(spark: SparkSession, d: str, deleted_alias: str | None = None) -> tuple[DataFrame, DataFrame]:
    ev = _t(spark, d, "events")
    cut = _events_cut(ev)
    wm = read_watermark(_events_log(ev, cut), "events", lookback_seconds=LOOKBACK_SECONDS)
    ext = incremental_extract(ev, "ts", wm, deleted=F.col("event_type") == "error",
                              include_deleted=True, deleted_alias=deleted_alias)
    return ev.where(F.col("event_id") < cut), ext


def q_scan_all(spark, d):
    return scan_all(spark, f"{d.rstrip('/')}/orders.parquet")


def q_watermark_lookup(spark, d):
    """The whole of events as a log of several tables, named by the event type."""
    log = _t(spark, d, "events").select(F.col("event_type").alias("table_name"), F.col("ts").alias("last_modified"))
    return watermark_lookup(log, LOG_NAME, lookback_seconds=LOOKBACK_SECONDS)


def q_watermark_literal(spark, d):
    return watermark_literal(q_watermark_lookup(spark, d))


def q_incremental_extract(spark, d):
    ev = _t(spark, d, "events")
    wm = read_watermark(_events_log(ev, _events_cut(ev)), "events", lookback_seconds=LOOKBACK_SECONDS)
    return incremental_extract(ev, "ts", wm)


def q_extract_with_deleted(spark, d):
    return _events_extract(spark, d, deleted_alias="is_deleted")[1]


def q_extract_text_watermark(spark, d):
    """Modification times as text with mixed offsets, all rows of events read."""
    ev = _t(spark, d, "events")
    cut = _events_cut(ev)
    wm = read_watermark(_events_log(ev, cut), "events", lookback_seconds=LOOKBACK_SECONDS)
    shape = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    west = F.date_format(F.col("ts") - F.make_dt_interval(hours=F.lit(7)), shape)
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.date_format("ts", shape), F.lit("Z"))).otherwise(
        F.concat(west, F.lit("-07:00")))
    return incremental_extract(ev.select("event_id", text.alias("modified")), "modified", wm)


def q_empty_short_circuit(spark, d):
    """Main table and logs after a second run that finds nothing new."""
    ev = _t(spark, d, "events")
    lake = LakePaths.under(scratch_path(spark, "empty_run"))
    cfg = replace(_events_sync_config(), lookback_seconds=0, deleted_col=None)
    sync(spark, ev, cfg, lake)
    again = sync(spark, ev, cfg, lake)
    logged = read_log(spark, lake.watermark_log).agg(F.count(F.lit(1)).alias("watermark_rows"))
    controls = read_log(spark, lake.control_log, CONTROL_LOG_SCHEMA).agg(F.count(F.lit(1)).alias("control_rows"))
    main = read_partitioned(spark, lake.main, "ts_yearmonth").select("event_id", "event_type", "ts_yearmonth")
    return (main.withColumn("second_run", F.lit(again.status))
                .crossJoin(F.broadcast(logged)).crossJoin(F.broadcast(controls)))


def q_flagship_sync(spark, d):
    """Watermark -> extract -> upsert on events (DataFrame form of the MERGE)."""
    target, ext = _events_extract(spark, d)
    change = ext.withColumn("value", F.col("value") * 2)
    return upsert_frames(target, change, ["event_id"], source_rows=ext.count())


def q_soft_delete_propagation(spark, d):
    ev = _t(spark, d, "events")
    cut = _events_cut(ev)
    # Loaded earlier while alive; the change set carries the current flag.
    target = encode_booleans(ev.where(F.col("event_id") < cut).withColumn("is_deleted", F.lit("false")),
                             ["is_deleted"])
    _, ext = _events_extract(spark, d, deleted_alias="is_deleted")
    change = encode_booleans(ext, ["is_deleted"])
    merged = upsert_frames(target, change, ["event_id"], source_rows=change.count())
    return merged.select("event_id", "event_type", "is_deleted")


def q_audit_watermark_row(spark, d):
    main = q_flagship_sync(spark, d)
    row = watermark_row(main, "events", "ts", ZONE, at=RUN_AT)
    return row.withColumn("run_time", F.col("run_time").cast("timestamp_ntz"))


def q_control_log_row(spark, d):
    target, ext = _events_extract(spark, d)
    counts = merge_counts(target, ext, ["event_id"])
    row = control_row(ext, "events", "ts", ZONE, inserted=counts["inserted"], updated=counts["updated"], at=RUN_AT)
    return row.withColumn("run_time", F.col("run_time").cast("timestamp_ntz"))


def q_utc_to_zone(spark, d):
    ev = _t(spark, d, "events")
    return ev.select("event_id", "ts",
                     utc_to_zone(F.col("ts"), ZONE, ev.schema["ts"].dataType).alias("ts_local"))


def _events_sync_config() -> SyncConfig:
    return SyncConfig(table_name="events", key_cols=("event_id",), modified_col="ts",
                      created_col="ts", partition_col="ts_yearmonth", deleted_col="is_deleted",
                      lookback_seconds=LOOKBACK_SECONDS, zone=ZONE)


def q_full_sync(spark, d):
    """Two runs of the whole pipeline: the earlier 80 %, then everything."""
    ev = _t(spark, d, "events")
    cut = _events_cut(ev)
    src = ev.withColumn("is_deleted", F.when(F.col("event_type") == "error", "true").otherwise("false"))
    lake = LakePaths.under(scratch_path(spark, "full_sync"))
    cfg = _events_sync_config()
    sync(spark, src.where(F.col("event_id") < cut), cfg, lake)
    sync(spark, src, cfg, lake)
    return read_partitioned(spark, lake.main, "ts_yearmonth").select(*src.columns, "ts_yearmonth")


def q_stream_sync(spark, d):
    """The same load under Structured Streaming: events drained with availableNow."""
    from tidemark.streaming import start_sync_stream

    ev = _t(spark, d, "events")
    flag = F.when(F.col("event_type") == "error", "true").otherwise("false")
    root = scratch_path(spark, "stream_sync")
    # Several files, one a trigger: the stream is drained in several micro-batches.
    ev.repartition(4).write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/landing")
    lake = LakePaths.under(root)
    cfg = replace(_events_sync_config(), bool_columns=("is_deleted",), dedupe_by="ts")
    q = start_sync_stream(stream.withColumn("is_deleted", flag), cfg, lake,
                          checkpoint_location=f"{root}/_stream_checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return read_partitioned(spark, lake.main, "ts_yearmonth").select(*ev.columns, "is_deleted", "ts_yearmonth")


# ---------------------------------------------------------------- cleaning fixtures

def _scrub_fixture(spark, d):
    c = _t(spark, d, "customer")
    return c.select(
        "c_custkey", "c_name",
        F.concat("c_name", F.lit("null")).alias("c_name_tail"),
        F.concat(F.lit("null"), "c_mktsegment", F.lit("nullify")).alias("c_segment_both"),
        F.concat(F.lit("NULL"), "c_mktsegment").alias("c_segment_upper"),
        "c_nationkey")


def q_null_token_scrub(spark, d):
    return null_token_scrub(_scrub_fixture(spark, d))


def _bool_fixture(spark, d):
    lb = _t(spark, d, "labels")
    return lb.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("quality") == 1, "true").otherwise("false").alias("quality_flag"),
        F.when(F.col("toxic") == 1, "true").otherwise("").alias("toxic_flag"),
        F.when(F.col("quality") == 1, "true").otherwise("maybe").alias("mixed_text"),
        F.when(F.col("toxic") == 1, "").alias("blank_text"))


def q_bool_detect(spark, d):
    return bool_detect(_bool_fixture(spark, d))


def q_bool_encode(spark, d):
    return encode_booleans(_bool_fixture(spark, d))


def q_year_month_key(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return add_year_month(o, "o_orderdate", "o_yearmonth")


def q_cast_all_string(spark, d):
    return cast_all_string(_t(spark, d, "orders"))


def q_cast_all_string_lineitem(spark, d):
    return cast_all_string(_t(spark, d, "lineitem"))


def q_retype_timestamps(spark, d):
    return retype_timestamps(cast_all_string(_t(spark, d, "orders")), ["o_orderdate"], ntz=True)


CUSTOMER_RENAMES = {"c_custkey": "customer_key", "c_acctbal": "account_balance",
                    "c_mktsegment": "market_segment"}


def q_rename_for_sink(spark, d):
    return rename_for_sink(_t(spark, d, "customer"), CUSTOMER_RENAMES, limit=30)


# ---------------------------------------------------------------- tables and upserts

def _orders_ym(spark, d):
    return add_year_month(_t(spark, d, "orders"), "o_orderdate", "o_yearmonth")


def q_stage_overwrite(spark, d):
    df = _orders_ym(spark, d)
    return stage_overwrite(df, scratch_path(spark, "stage"), "o_yearmonth").select(*df.columns)


def q_compact_table(spark, d):
    df = _orders_ym(spark, d)
    path = scratch_path(spark, "compact")
    # Many small files: every input slice writes a file into every month.
    write_partitioned(df.repartition(16), path, "o_yearmonth", dynamic=False, rebalance=False)
    # More than eight small files a month, so every month is one to compact.
    return compact_table(spark, path, "o_yearmonth", df.schema).select(*df.columns)


def _orders_change(spark, d, move_months: bool) -> tuple[DataFrame, DataFrame]:
    target = _orders_ym(spark, d)
    upd = target.where(F.col("o_orderstatus") == "O").withColumns({
        "o_totalprice": F.col("o_totalprice") + 1,
        "o_orderpriority": F.lit("1-URGENT")})
    if move_months:
        upd = add_year_month(
            upd.withColumn("o_orderdate", F.col("o_orderdate") + F.make_dt_interval(days=F.lit(40))),
            "o_orderdate", "o_yearmonth")
    new = (target.where(F.col("o_orderstatus") == "P")
                 .withColumn("o_orderkey", F.col("o_orderkey") + F.lit(NEW_KEY_OFFSET)))
    return target, upd.unionByName(new)


def _upsert_query(spark, d, key_only: bool):
    target, source = _orders_change(spark, d, move_months=key_only)
    path = scratch_path(spark, "upsert")
    write_partitioned(target, path, "o_yearmonth", dynamic=False)
    # A known change-set size lets the upsert broadcast the source keys (size
    # checked) and leave the target rows unshuffled, as a sync run does.
    upsert_table(source, path, ["o_orderkey"], "o_yearmonth", key_only=key_only,
                 source_rows=source.count())
    return read_table(spark, path, target.schema).select(*target.columns)


def q_upsert_composite(spark, d):
    return _upsert_query(spark, d, key_only=False)


def q_upsert_single_key(spark, d):
    return _upsert_query(spark, d, key_only=True)


def q_upsert_null_partition(spark, d):
    """NULL and empty partition values share a folder; an upsert into it keeps its rows."""
    o = _t(spark, d, "orders")
    ym = F.date_format("o_orderdate", "yyyyMM")
    target = o.withColumn("part", F.when(F.col("o_orderstatus") != "F", ym))
    source = o.where(F.col("o_orderstatus") == "P").withColumn("part", F.lit(""))
    path = scratch_path(spark, "upsert_null")
    write_partitioned(target, path, "part", dynamic=False)
    upsert_table(source, path, ["o_orderkey"], "part", source_rows=source.count())
    return read_table(spark, path, target.schema).select(*target.columns)


def q_upsert_subset_columns(spark, d):
    """A source with three of the columns updates only those."""
    target, source = _orders_change(spark, d, move_months=False)
    path = scratch_path(spark, "upsert_subset")
    write_partitioned(target, path, "o_yearmonth", dynamic=False)
    upsert_table(source.select("o_orderkey", "o_totalprice", "o_yearmonth"), path, ["o_orderkey"], "o_yearmonth",
                 source_rows=source.count())
    return read_table(spark, path, target.schema).select(*target.columns)


def q_duplicate_source_keys(spark, d):
    return duplicate_keys(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def q_dedupe_source_keys(spark, d):
    return dedupe_latest(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LINEITEM_ORDER)


# ---------------------------------------------------------------- numbering, slices, QA

def q_row_number_desc(spark, d):
    return row_number_ranged(_t(spark, d, "orders"), ["o_orderkey"], "row_no", descending=True)


def q_batch_slices(spark, d):
    # A summary needs the key alone: only that goes through the checkpoint.
    keys = _t(spark, d, "orders").select("o_orderkey")
    return batch_summary(row_number_ranged(keys, ["o_orderkey"], "row_no", descending=True), SLICE_SIZE, "row_no")


def q_slice_rows(spark, d):
    """The second slice of the publish loop."""
    return slice_rows(q_row_number_desc(spark, d), SLICE_SIZE, 2 * SLICE_SIZE, "row_no")


def _orders_altered(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    kept = o.where(F.col("o_orderstatus") != "P").withColumn(
        "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = o.where(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.col("o_orderkey") + F.lit(NEW_KEY_OFFSET))
    return kept.unionByName(new)


def q_qa_compare(spark, d):
    return qa_diff(_t(spark, d, "orders"), _orders_altered(spark, d), ["o_orderkey"])


def q_qa_union(spark, d):
    return qa_union(_t(spark, d, "orders"), _orders_altered(spark, d), ("left", "right"))


def q_qa_id_list(spark, d):
    """The same for a list of ids, NULL and text among them."""
    ids = [None, "no number", *range(1, 3000, 7)]
    return qa_union(_t(spark, d, "orders"), _orders_altered(spark, d), ("left", "right"), key="o_orderkey", ids=ids)


# ---------------------------------------------------------------- connector, index, publication

def q_connector_scan(spark, d):
    """The extract through the paged connector: its watermark filter reaches the reader."""
    ev = _t(spark, d, "events")
    wm = read_watermark(_events_log(ev, _events_cut(ev)), "events", lookback_seconds=LOOKBACK_SECONDS)
    flag = F.when(F.col("event_type") == "error", "true").otherwise("false")
    root = scratch_path(spark, "pages")
    write_pages(ev.withColumn("is_deleted", flag), root, "events", "39.0", "event_id", page_rows=1000)
    src = connector_scan(spark, root, "events", "39.0", columns=[*ev.columns, "is_deleted"], query_all=True)
    return incremental_extract(src, "ts", wm)


def q_upsert_key_index(spark, d):
    """The single-key upsert in two runs: the first builds the key index, the second probes by it."""
    target, source = _orders_change(spark, d, move_months=True)
    path = scratch_path(spark, "upsert_indexed")
    write_partitioned(target, path, "o_yearmonth", dynamic=False)
    for half in (0, 1):
        part = source.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == half)
        upsert_table(part, path, ["o_orderkey"], "o_yearmonth", key_only=True, source_rows=part.count(), index_path=f"{path}_keys")
    return read_table(spark, path, target.schema).select(*target.columns)


def _fresh_name(kind: str) -> str:
    return f"tidemark_{kind}_{uuid.uuid4().hex[:12]}"


def q_upsert_bucketed(spark, d):
    """The composite upsert into a bucketed main table: the target's rows are not moved."""
    target, source = _orders_change(spark, d, move_months=False)
    name = _fresh_name("bucketed")
    create_bucketed(target, name, scratch_path(spark, name), ["o_orderkey"], "o_yearmonth", buckets=8)
    upsert_bucketed(source, name, ["o_orderkey"], "o_yearmonth", buckets=8)
    return spark.table(name).select(*target.columns)


def q_publish_switch(spark, d):
    """Stage overwrite and composite upsert published by catalog switches."""
    target, source = _orders_change(spark, d, move_months=False)
    name = _fresh_name("switched")
    path = scratch_path(spark, name)
    create_table(spark, name, target.schema, "o_yearmonth", path)
    publish_overwrite(target, name, path, "o_yearmonth")
    publish_upsert(source, name, path, ["o_orderkey"], "o_yearmonth", source_rows=source.count())
    return spark.table(name).select(*target.columns)


def q_merge_generated(spark, d):
    """The composite upsert as a generated statement that Spark runs."""
    target, source = _orders_change(spark, d, move_months=False)
    name, view = _fresh_name("generated"), _fresh_name("source")
    target.write.partitionBy("o_yearmonth").format("parquet").option("path", scratch_path(spark, name)).saveAsTable(name)
    source.createOrReplaceTempView(view)
    run_generated(spark, merge_overwrite_sql(name, view, target.columns, ["o_orderkey"], "o_yearmonth"))
    spark.catalog.dropTempView(view)
    return spark.table(name).select(*target.columns)


def q_qa_digest(spark, d):
    return qa_diff_tree(_t(spark, d, "orders"), _orders_altered(spark, d), ["o_orderkey"], leaf_rows=200, fanout=64)


def q_compact_bins(spark, d):
    """A table of many small files, packed into bins."""
    orders = _orders_ym(spark, d)
    path = scratch_path(spark, "bins")
    write_partitioned(orders.repartition(4), path, "o_yearmonth", dynamic=False, rebalance=False)
    compact_bins(spark, path, "o_yearmonth", orders.schema)
    return read_table(spark, path, orders.schema).select(*orders.columns)


def q_sliced_sink(spark, d):
    """Orders numbered, sliced and published by the committing sink, read back from its manifest."""
    rows = slice_ids(row_number_ranged(_t(spark, d, "orders"), ["o_orderkey"], "row_no", descending=True), SLICE_SIZE, "row_no", "slice")
    path = scratch_path(spark, "slices")
    publish_slices(rows, path, "orders", "slice")
    return read_slices(spark, path, "orders", rows.schema)


PULLS = 4


def q_stream_lookback(spark, d):
    """Pulls with the look-back as a stream: repeated rows pass once, late ones are kept.

    Pull k holds its quarter of the events and again those of the look-back
    before it; of the events in a pull's last look-back every fifth is not yet
    visible and comes with the next pull only.
    """
    from tidemark.streaming.lookback import drop_redelivered

    ev = _t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    root = scratch_path(spark, "lookback")
    n = ev.count()
    cuts = [n * k // PULLS for k in range(PULLS + 1)]
    ends = [ev.where(F.col("event_id") < c).agg(F.max("ts").alias("m")).first().m for c in cuts]
    back = F.make_dt_interval(secs=F.lit(LOOKBACK_SECONDS))
    for k in range(PULLS):
        mine = (F.col("event_id") >= cuts[k]) & (F.col("event_id") < cuts[k + 1])
        again = F.lit(False)
        if k:
            again = (F.col("event_id") < cuts[k]) & (F.col("ts") > F.lit(ends[k]) - back)
        late = F.lit(False)
        if k < PULLS - 1:
            late = mine & (F.col("ts") > F.lit(ends[k + 1]) - back) & (F.col("event_id") % 5 == 0) & (F.col("ts") < F.lit(ends[k + 1]))
        # One file a pull, which is one micro-batch.
        ev.where((mine | again) & ~late).coalesce(1).write.mode("append").parquet(f"{root}/pulls")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/pulls")
    q = (drop_redelivered(stream, ["event_id", "ts"], "ts", LOOKBACK_SECONDS).writeStream.format("parquet")
         .option("path", f"{root}/passed").option("checkpointLocation", f"{root}/_stream_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return spark.read.schema(ev.schema).parquet(f"{root}/passed").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_all": q_scan_all,
    "watermark_lookup": q_watermark_lookup,
    "watermark_literal": q_watermark_literal,
    "incremental_extract": q_incremental_extract,
    "extract_with_deleted": q_extract_with_deleted,
    "empty_short_circuit": q_empty_short_circuit,
    "null_token_scrub": q_null_token_scrub,
    "bool_detect": q_bool_detect,
    "bool_encode": q_bool_encode,
    "year_month_key": q_year_month_key,
    "cast_all_string": q_cast_all_string,
    "cast_all_string_lineitem": q_cast_all_string_lineitem,
    "retype_timestamps": q_retype_timestamps,
    "rename_for_sink": q_rename_for_sink,
    "stage_overwrite": q_stage_overwrite,
    "compact_table": q_compact_table,
    "upsert_composite": q_upsert_composite,
    "upsert_single_key": q_upsert_single_key,
    "duplicate_source_keys": q_duplicate_source_keys,
    "dedupe_source_keys": q_dedupe_source_keys,
    "soft_delete_propagation": q_soft_delete_propagation,
    "row_number_desc": q_row_number_desc,
    "batch_slices": q_batch_slices,
    "qa_compare": q_qa_compare,
    "qa_union": q_qa_union,
    "qa_id_list": q_qa_id_list,
    "slice_rows": q_slice_rows,
    "extract_text_watermark": q_extract_text_watermark,
    "upsert_null_partition": q_upsert_null_partition,
    "upsert_subset_columns": q_upsert_subset_columns,
    "utc_to_zone": q_utc_to_zone,
    "audit_watermark_row": q_audit_watermark_row,
    "control_log_row": q_control_log_row,
    "flagship_sync": q_flagship_sync,
    "full_sync": q_full_sync,
    "stream_sync": q_stream_sync,
    "connector_scan": q_connector_scan,
    "upsert_key_index": q_upsert_key_index,
    "upsert_bucketed": q_upsert_bucketed,
    "publish_switch": q_publish_switch,
    "merge_generated": q_merge_generated,
    "qa_digest": q_qa_digest,
    "compact_bins": q_compact_bins,
    "sliced_sink": q_sliced_sink,
    "stream_lookback": q_stream_lookback,
}
