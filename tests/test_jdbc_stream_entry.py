import os
import sys

import pytest
from pyspark.sql import functions as F

from tidemark.config import SyncConfig
from tidemark.plans.sync import LakePaths
from tidemark.sinks.jdbc import merge_sql, prepare_for_sink
from tidemark.sources.jdbc import jdbc_watermark_query
from tidemark.sources.tables import read_partitioned
from tidemark.streaming import start_sync_stream

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_merge_sql_single_key():
    sql = merge_sql("T", "S", ["ID", "A", "B"], ["ID"])
    assert sql == ("MERGE INTO T tgt USING S src ON (tgt.ID = src.ID) WHEN MATCHED THEN UPDATE SET "
                   "tgt.A = src.A, tgt.B = src.B WHEN NOT MATCHED THEN INSERT (ID, A, B) VALUES (src.ID, src.A, src.B)")
    comp = merge_sql("T", "S", ["ID", "P", "A"], ["ID", "P"], quote='"')
    assert 'ON (tgt."ID" = src."ID" AND tgt."P" = src."P")' in comp and 'SET tgt."A" = src."A"' in comp
    part = merge_sql("T", "S", ["ID", "A", "B"], ["ID"], update_columns=["B"])
    assert "SET tgt.B = src.B WHEN" in part and "INSERT (ID, A, B)" in part
    with pytest.raises(ValueError):
        merge_sql("T", "S", ["A"], ["ID"])


def test_watermark_subquery_text():
    q = jdbc_watermark_query("LOG", "O'BJ", "modified", "name", 600)
    assert q == ("SELECT MAX(modified) - INTERVAL '600' SECOND AS watermark, MAX(modified) AS top FROM LOG "
                 "WHERE name = 'O''BJ'")


def test_prepare_for_sink(spark):
    df = spark.createDataFrame([("1", "2024-01-01T00:00:00.000Z", "x")], "Id string, CreatedDate string, LongName string")
    out = prepare_for_sink(df, {"LongName": "Short"}, ["CreatedDate"])
    assert out.columns == ["Id", "CreatedDate", "Short"]
    assert out.schema["CreatedDate"].dataType.simpleString() == "timestamp"


def test_stream_runs_the_same_load(spark, tmp_root):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = ev.withColumn("is_deleted", F.when(F.col("event_type") == "error", "true").otherwise("false"))
    land = f"{tmp_root}/landing"
    src.where("event_id < 500").write.parquet(f"{land}/part1")
    lake = LakePaths.under(f"{tmp_root}/lake")
    cfg = SyncConfig(table_name="events", key_cols=("event_id",), modified_col="ts", created_col="ts",
                     partition_col="ts_yearmonth", deleted_col="is_deleted", bool_columns=("is_deleted",),
                     dedupe_by="ts")
    stream = spark.readStream.schema(src.schema).option("recursiveFileLookup", "true").parquet(land)
    q = start_sync_stream(stream, cfg, lake, checkpoint_location=f"{tmp_root}/ckpt")
    q.awaitTermination(120)
    assert read_partitioned(spark, lake.main, "ts_yearmonth").count() == 500
    src.where("event_id >= 400").write.parquet(f"{land}/part2")
    q = start_sync_stream(stream, cfg, lake, checkpoint_location=f"{tmp_root}/ckpt")
    q.awaitTermination(120)
    main = read_partitioned(spark, lake.main, "ts_yearmonth")
    assert main.count() == ev.count()
    assert main.where("is_deleted = '1'").count() == ev.where("event_type = 'error'").count()


def test_entry_contract(spark):
    import __spark_entry__ as E
    from tidemark.plans.queries import QUERIES

    assert E.entry(spark).columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]
    qs, ors = E.queries(), E.oracle_sql()
    # Every query of the reference's own operators has an oracle.
    assert set(QUERIES) <= set(qs) and set(QUERIES) <= set(ors)


def test_bounded_publish_loop_without_a_database(spark):
    from tidemark.sinks.jdbc import jdbc_publish

    df = spark.range(0, 25).selectExpr("cast(id as string) as Id", "'2024-01-01T00:00:00.000Z' as CreatedDate",
                                       "'x' as VeryLongColumnNameThatNeedsRenaming")
    written, statements = [], []

    def writer(part, url, table, mode, **kw):
        written.append((table, mode, sorted(r.Id for r in part.collect()), part.columns))

    def executor(spark_, url, sql, props):
        statements.append(sql)
        return 0

    sizes = jdbc_publish(spark, df, "jdbc:none", "STG", "TGT", ["Id"], slice_size=10, bounded=True,
                         rename_map={"VeryLongColumnNameThatNeedsRenaming": "ShortName"},
                         timestamp_cols=["CreatedDate"], writer=writer, executor=executor)
    assert sizes == [(0, 10), (1, 10), (2, 5)]
    assert len(written) == 3 and len(statements) == 3
    assert all(w[0] == "STG" and w[1] == "overwrite" for w in written)
    assert written[0][3] == ["Id", "CreatedDate", "ShortName"]
    # slices follow the key in descending order, as ROW_NUMBER() OVER (ORDER BY Id DESC)
    ids = sorted((r.Id for r in df.collect()), reverse=True)
    assert written[0][2] == sorted(ids[:10]) and written[2][2] == sorted(ids[20:])
    assert statements[0].startswith("MERGE INTO TGT tgt USING STG src ON (tgt.Id = src.Id)")
    assert sorted(i for w in written for i in w[2]) == sorted(ids)
