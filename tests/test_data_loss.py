"""Inputs that once lost rows or values without an error."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.config import SyncConfig
from tidemark.operators.qa import qa_union
from tidemark.operators.upsert import dedupe_latest, fits_broadcast, upsert_frames
from tidemark.plans.sync import CONTROL_LOG_SCHEMA, JdbcLogs, LakePaths, read_log, sync
from tidemark.session import drop_scratch, ensure_checkpoint_dir, scratch_path
from tidemark.sinks.jdbc import jdbc_publisher
from tidemark.sinks.table import compact_table, crowded_partitions, upsert_table, write_partitioned
from tidemark.sources.extract import incremental_extract
from tidemark.sources.tables import read_partitioned
from tidemark.streaming import start_sync_stream

ROWS = "id int, v string, p string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_text_watermark_compares_instants(spark):
    src = spark.createDataFrame([(1, "2024-01-09T23:30:00.000-0700"), (2, "2024-01-10T00:30:00.000+0000"), (3, "")], "id int, m string")
    assert [r.id for r in incremental_extract(src, "m", "2024-01-10 01:00:00").collect()] == [1]
    twice = spark.createDataFrame([(1, "2024-01-10T01:00:00+0300"), (1, "2024-01-10T00:00:00Z")], "id int, m string")
    assert [r.m for r in dedupe_latest(twice, ["id"], "m").collect()] == ["2024-01-10T00:00:00Z"]


def test_typed_watermark_is_still_pushed(spark, tmp_root):
    spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, m timestamp").write.parquet(f"{tmp_root}/t")
    plan = incremental_extract(spark.read.parquet(f"{tmp_root}/t"), "m", "2023-01-01 00:00:00")._jdf.queryExecution().toString()
    assert "GreaterThan(m," in plan


@pytest.mark.parametrize("key_only", [False, True])
def test_empty_and_null_partition_are_one(spark, tmp_root, key_only):
    path = f"{tmp_root}/t"
    write_partitioned(spark.createDataFrame([(1, "old", None), (2, "old", "a")], ROWS), path, "p", dynamic=False)
    upsert_table(spark.createDataFrame([(3, "new", "")], ROWS), path, ["id"], "p", key_only=key_only, source_rows=1)
    assert rows(read_partitioned(spark, path, "p")) == [(1, "old", None), (2, "old", "a"), (3, "new", None)]


def test_source_without_a_column_keeps_it(spark, tmp_root):
    path = f"{tmp_root}/t"
    write_partitioned(spark.createDataFrame([(1, "x", "a"), (2, "y", "a")], ROWS).withColumn("w", F.lit(5)), path, "p", dynamic=False)
    upsert_table(spark.createDataFrame([(1, "new", "a"), (3, "new", "a")], ROWS), path, ["id"], "p", source_rows=2)
    out = {r.id: (r.v, r.w) for r in read_partitioned(spark, path, "p").collect()}
    assert out == {1: ("new", 5), 2: ("y", 5), 3: ("new", None)}
    with pytest.raises(ValueError, match="no columns"):
        upsert_table(spark.createDataFrame([(1, "x", "a", 1)], ROWS + ", other int"), path, ["id"], "p")


def test_duplicate_source_keys_are_refused(spark, tmp_root):
    twice = spark.createDataFrame([(1, "a", "p"), (1, "b", "p")], ROWS)
    with pytest.raises(ValueError, match="duplicate keys"):
        upsert_table(twice, f"{tmp_root}/t", ["id"], "p")


def test_newest_wins(spark, tmp_root):
    path = f"{tmp_root}/t"
    schema = "id int, m timestamp, p string"
    write_partitioned(spark.createDataFrame([(1, datetime(2024, 2, 1), "a"), (2, datetime(2024, 2, 1), "a")], schema), path, "p", dynamic=False)
    upsert_table(spark.createDataFrame([(1, datetime(2024, 1, 1), "b"), (2, datetime(2024, 3, 1), "b")], schema), path, ["id"], "p",
                 key_only=True, newest_by="m", source_rows=2)
    assert rows(read_partitioned(spark, path, "p")) == [(1, datetime(2024, 2, 1), "a"), (2, datetime(2024, 3, 1), "b")]


def test_layouts_give_the_same_rows(spark, tmp_root):
    base = spark.range(400).selectExpr("cast(id as int) id", "'o' v", "cast(id % 4 as string) p")
    change = spark.range(350, 450).selectExpr("cast(id as int) id", "'n' v", "cast(id % 4 as string) p")
    found = []
    for layout in ("narrow", "rebalance"):
        path = f"{tmp_root}/{layout}"
        write_partitioned(base, path, "p", dynamic=False)
        upsert_table(change, path, ["id"], "p", source_rows=100, layout=layout)
        found.append(rows(read_partitioned(spark, path, "p")))
    assert found[0] == found[1] and len(found[0]) == 450


def test_emptied_partition_goes(spark, tmp_root):
    path = f"{tmp_root}/t"
    write_partitioned(spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "x", "b")], ROWS), path, "p", dynamic=False)
    res = upsert_table(spark.createDataFrame([(1, "n", "c"), (2, "n", "c")], ROWS), path, ["id"], "p", key_only=True, source_rows=2)
    assert res.emptied == ["a"] and rows(read_partitioned(spark, path, "p")) == [(1, "n", "c"), (2, "n", "c"), (3, "x", "b")]


def test_compaction_takes_crowded_partitions_only(spark, tmp_root):
    path = f"{tmp_root}/t"
    write_partitioned(spark.createDataFrame([(1, "x", "sound")], ROWS), path, "p", dynamic=False)
    many = spark.range(40).selectExpr("cast(id as int) id", "'x' v", "'crowded' p").repartition(20)
    write_partitioned(many, path, "p", rebalance=False)
    sound = spark.read.parquet(f"{path}/p=sound").inputFiles()
    assert crowded_partitions(spark, path, "p", ["sound", "crowded"]) == ["crowded"]
    assert compact_table(spark, path, "p").count() == 41
    assert spark.read.parquet(f"{path}/p=sound").inputFiles() == sound
    assert crowded_partitions(spark, path, "p", ["sound", "crowded"]) == []


def test_broadcast_counts_true_key_width(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 2000).alias("k"))
    assert not fits_broadcast(wide, 100, 100 * 1000) and fits_broadcast(wide, 100, 100 * 3000) and not fits_broadcast(wide, None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.range(50).selectExpr("id", "id v")
        plan = upsert_frames(t, t.limit(5), ["id"], source_rows=5)._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_id_lists_of_any_length_match_alike(spark):
    a = spark.createDataFrame([("007",), ("7",), ("8",)], "k string")
    for ids in ([7], [7, None, *range(1000, 2100)]):
        assert [r.k for r in qa_union(a, a.limit(0), key="k", ids=ids).collect()] == ["7"]
    n = spark.createDataFrame([(7,), (8,)], "k int")
    assert [r.k for r in qa_union(n, n.limit(0), key="k", ids=[None, "7", "x"]).collect()] == [7]


def _cfg(**kw):
    base = dict(table_name="T", key_cols=("Id",), modified_col="m", partition_col="ym", created_col="m", lookback_seconds=0)
    return SyncConfig(**{**base, **kw})


SRC = "Id string, m timestamp, note string"


def test_dedupe_keys_are_the_merge_keys_after_the_scrub(spark, tmp_root):
    lake = LakePaths.under(tmp_root)
    src = spark.createDataFrame([("a", datetime(2024, 1, 1), "x"), ("a", datetime(2024, 2, 1), "x"),
                                 ("nullb", datetime(2024, 1, 2), "old"), ("b", datetime(2024, 1, 3), "new")], SRC)
    sync(spark, src, _cfg(dedupe_by="m"), lake)
    assert sorted((r.Id, r.ym, r.note) for r in read_partitioned(spark, lake.main, "ym").collect()) == [
        ("a", "202401", "x"), ("a", "202402", "x"), ("b", "202401", "new")]
    with pytest.raises(ValueError, match="duplicate keys"):
        sync(spark, src, _cfg(), LakePaths.under(f"{tmp_root}/other"))


def test_boolean_columns_stay_as_first_detected(spark, tmp_root):
    lake = LakePaths.under(tmp_root)
    first = spark.createDataFrame([("a", datetime(2024, 1, 1), "true"), ("b", datetime(2024, 1, 1), "maybe")], SRC)
    second = spark.createDataFrame([("c", datetime(2024, 1, 2), "true")], SRC)
    assert sync(spark, first, _cfg(), lake).boolean_columns == []
    assert sync(spark, second, _cfg(), lake).boolean_columns == []
    assert sorted(r.note for r in read_partitioned(spark, lake.main, "ym").collect()) == ["maybe", "true", "true"]


def test_no_silent_local_folder(spark, tmp_root):
    before = spark.conf.get("spark.checkpoint.dir")
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    drop_scratch(spark, path)
    with pytest.raises(ValueError):
        drop_scratch(spark, tmp_root)
    assert ensure_checkpoint_dir(spark, "spark://host:7077") == before  # set: used anywhere

    class Unset:
        class conf:  # noqa: N801 - stands for a session without the setting
            get = staticmethod(lambda *a: None)

        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Unset, "spark://host:7077")


def test_stream_needs_its_settings_and_survives_versions(spark, tmp_root):
    lake = LakePaths.under(f"{tmp_root}/lake")
    land = f"{tmp_root}/land"
    cfg = _cfg(bool_columns=(), dedupe_by="m", merge_on_partition=False)
    spark.createDataFrame([("a", datetime(2024, 1, 5), "newer"), ("a", datetime(2024, 1, 4), "same batch")], SRC).coalesce(1).write.parquet(f"{land}/1")
    stream = spark.readStream.schema(SRC).option("recursiveFileLookup", "true").parquet(land)
    with pytest.raises(ValueError, match="checkpoint_location"):
        start_sync_stream(stream, cfg, lake, checkpoint_location="")
    with pytest.raises(ValueError, match="bool_columns"):
        start_sync_stream(stream, _cfg(), lake, checkpoint_location=f"{tmp_root}/c")
    start_sync_stream(stream, cfg, lake, checkpoint_location=f"{tmp_root}/c").awaitTermination()
    spark.createDataFrame([("a", datetime(2024, 1, 1), "older")], SRC).write.parquet(f"{land}/2")
    start_sync_stream(stream, cfg, lake, checkpoint_location=f"{tmp_root}/c").awaitTermination()
    assert [r.note for r in read_partitioned(spark, lake.main, "ym").collect()] == ["newer"]
    ids = [r.batch_id for r in read_log(spark, lake.control_log, CONTROL_LOG_SCHEMA).collect()]
    assert len(set(ids)) == 2 and all(ids)


def test_logs_and_publish_in_a_database_without_one(spark, tmp_root):
    store = {"LOG": [], "CTL": []}
    queries, published, statements = [], [], []

    def reader(query):
        queries.append(query)
        top = max((r.last_modified for r in store["LOG"]), default=None)
        return spark.createDataFrame([(top, top)], "watermark timestamp, top timestamp")

    logs = JdbcLogs(spark, "jdbc:none", "LOG", "CTL", reader=reader, writer=lambda df, table: store[table].extend(df.collect()))
    cfg = _cfg(rename_map={"note": "remark"}, timestamp_cols=("m",))
    publish = jdbc_publisher(cfg, "jdbc:none", "STG", "TGT", writer=lambda df, *a, **k: published.append(df.columns),
                             executor=lambda s, url, sql, props: statements.append(sql) or 0)
    lake = LakePaths.under(tmp_root, stage_table="dl_stage", main_table="dl_main")
    src = spark.createDataFrame([("a", datetime(2024, 1, 1), "x"), ("b", datetime(2024, 1, 2), "y")], SRC)
    assert sync(spark, src, cfg, lake, publisher=publish, logs=logs).inserted == 2
    assert sync(spark, src, cfg, lake, publisher=publish, logs=logs).status == "empty"
    assert "FROM LOG WHERE table_name = 'T'" in queries[0] and len(store["LOG"]) == len(store["CTL"]) == 1
    assert published == [["Id", "m", "remark", "ym"]] and "tgt.remark = src.remark" in statements[0]
    assert spark.table("dl_main").count() == 2 and spark.table("dl_stage").count() == 2
