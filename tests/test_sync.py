from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.config import SyncConfig
from tidemark.plans.sync import CONTROL_LOG_SCHEMA, LakePaths, read_log, sync
from tidemark.sources.tables import read_partitioned

SRC = "Id string, CreatedDate string, LastModifiedDate timestamp_ntz, IsDeleted string, Note string"
T0 = datetime(2024, 1, 10, 12)


def cfg(**kw):
    base = dict(table_name="OBJ", key_cols=("Id",), modified_col="LastModifiedDate",
                created_col="CreatedDate", partition_col="Created_YearMonth", deleted_col="IsDeleted")
    base.update(kw)
    return SyncConfig(**base)


def main_rows(spark, lake):
    df = read_partitioned(spark, lake.main, "Created_YearMonth")
    return sorted((r.Id, r.IsDeleted, r.Note, r.Created_YearMonth) for r in df.collect())


def test_two_runs_then_empty_run(spark, tmp_root):
    lake = LakePaths.under(tmp_root)
    first = spark.createDataFrame([
        ("a", "2024-01-01T00:00:00.000Z", T0, "false", "null one"),
        ("b", "2024-02-01T00:00:00.000Z", T0 + timedelta(minutes=5), "false", "two"),
    ], SRC)
    r1 = sync(spark, first, cfg(), lake)
    assert (r1.status, r1.watermark, r1.extracted, r1.inserted, r1.updated) == ("merged", None, 2, 2, 0)
    assert r1.boolean_columns == ["IsDeleted"]
    assert main_rows(spark, lake) == [("a", "0", " one", "202401"), ("b", "0", "two", "202402")]

    # second run: b soft-deleted (late, inside the look-back), c new; a unchanged
    second = first.unionByName(spark.createDataFrame([
        ("b", "2024-02-01T00:00:00.000Z", T0 + timedelta(minutes=6), "true", "two"),
        ("c", "2024-03-01T00:00:00.000Z", T0 + timedelta(minutes=30), "false", "three"),
    ], SRC)).where(~((F.col("Id") == "b") & (F.col("IsDeleted") == "false")))
    r2 = sync(spark, second, cfg(), lake)
    assert r2.watermark == "2024-01-10 11:55:00.000000"     # 12:05 - 600 s
    # a (12:00) is past 11:55, so the look-back delivers it again: updated, unchanged
    assert (r2.extracted, r2.inserted, r2.updated) == (3, 1, 2)
    assert main_rows(spark, lake) == [("a", "0", " one", "202401"), ("b", "1", "two", "202402"),
                                      ("c", "0", "three", "202403")]

    log = read_log(spark, lake.watermark_log)
    marks = sorted(r.last_modified for r in log.collect())
    assert marks == [datetime(2024, 1, 10, 12, 5), datetime(2024, 1, 10, 12, 30)]
    ctl = sorted((r.merge_count, r.inserted_rows, r.updated_rows) for r in read_log(spark, lake.control_log, CONTROL_LOG_SCHEMA).collect())
    assert ctl == [(2, 2, 0), (3, 1, 2)]

    # third run: nothing new past the watermark minus look-back -> empty, nothing written
    r3 = sync(spark, second.where(F.col("LastModifiedDate") < T0), cfg(), lake)
    assert r3.status == "empty"
    assert read_log(spark, lake.watermark_log).count() == 2

    # re-running the second run's input is harmless (idempotent upsert)
    sync(spark, second, cfg(), lake)
    assert len(main_rows(spark, lake)) == 3


def test_key_only_sync_moves_partition(spark, tmp_root):
    lake = LakePaths.under(tmp_root)
    c = cfg(merge_on_partition=False)
    sync(spark, spark.createDataFrame([("a", "2024-01-01", T0, "false", "x")], SRC), c, lake)
    sync(spark, spark.createDataFrame([("a", "2024-05-01", T0 + timedelta(hours=1), "false", "y")], SRC), c, lake)
    assert main_rows(spark, lake) == [("a", "0", "y", "202405")]


def test_duplicate_keys_deduped_by_latest(spark, tmp_root):
    lake = LakePaths.under(tmp_root)
    src = spark.createDataFrame([("a", "2024-01-01", T0, "false", "old"),
                                 ("a", "2024-01-01", T0 + timedelta(seconds=1), "false", "new")], SRC)
    sync(spark, src, cfg(dedupe_by="LastModifiedDate"), lake)
    assert main_rows(spark, lake) == [("a", "0", "new", "202401")]


def test_config_errors_are_explicit(spark, tmp_root):
    import pytest

    lake = LakePaths.under(tmp_root)
    src = spark.createDataFrame([("a", "2024-01-01", T0, "false", "x")], SRC)
    with pytest.raises(ValueError, match="created_col"):
        sync(spark, src, cfg(created_col=None), lake)
    with pytest.raises(ValueError, match="key columns"):
        sync(spark, src, cfg(key_cols=("Nope",)), lake)


def test_without_deleted_rows_main_keeps_old_version(spark, tmp_root):
    lake = LakePaths.under(tmp_root)
    c = cfg(include_deleted=False, bool_columns=("IsDeleted",))
    sync(spark, spark.createDataFrame([("a", "2024-01-01", T0, "false", "alive")], SRC), c, lake)
    later = spark.createDataFrame([("a", "2024-01-01", T0 + timedelta(hours=1), "true", "gone"),
                                   ("b", "2024-01-02", T0 + timedelta(hours=1), "false", "new")], SRC)
    r = sync(spark, later, c, lake)
    assert (r.extracted, r.inserted, r.updated) == (1, 1, 0)
    assert main_rows(spark, lake) == [("a", "0", "alive", "202401"), ("b", "0", "new", "202401")]


def test_log_marks_from_one_aggregate(spark):
    from tidemark.plans.sync import WATERMARK_LOG_SCHEMA, log_marks

    log = spark.createDataFrame([("OBJ", datetime(2024, 1, 1, 12), None), ("OBJ", datetime(2024, 1, 1, 13), None),
                                 ("OTHER", datetime(2030, 1, 1), None)], WATERMARK_LOG_SCHEMA)
    assert log_marks(log, "OBJ", 600) == ("2024-01-01 12:50:00.000000", "2024-01-01 13:00:00.000000")
    assert log_marks(log, "NONE", 600) == (None, None)
    assert log_marks(None, "OBJ", 600) == (None, None)
