from datetime import datetime

from pyspark.sql import functions as F

from tidemark.sources.extract import incremental_extract, is_empty
from tidemark.sources.watermark import read_watermark, watermark_literal, watermark_lookup

LOG_SCHEMA = "table_name string, last_modified timestamp_ntz"


def test_first_run_has_no_watermark(spark):
    log = spark.createDataFrame([], LOG_SCHEMA)
    assert read_watermark(log, "t") is None
    assert read_watermark(None, "t") is None
    assert watermark_lookup(log, "t").first()["watermark"] is None


def test_watermark_is_max_minus_lookback_for_one_table(spark):
    log = spark.createDataFrame([("t", datetime(2024, 1, 1, 10)), ("t", datetime(2024, 1, 1, 12)),
                                 ("other", datetime(2030, 1, 1))], LOG_SCHEMA)
    assert read_watermark(log, "t") == "2024-01-01 11:50:00.000000"
    assert read_watermark(log, "t", lookback_seconds=0) == "2024-01-01 12:00:00.000000"
    lit = watermark_literal(watermark_lookup(log, "t")).first()[0]
    assert lit == "2024-01-01T11:50:00Z"


def test_extract_is_strictly_greater_and_pushed_down(spark):
    src = spark.createDataFrame([(1, datetime(2024, 1, 1, 11, 50)), (2, datetime(2024, 1, 1, 11, 50, 0, 1)),
                                 (3, datetime(2024, 1, 1, 12))], "id int, ts timestamp_ntz")
    out = incremental_extract(src, "ts", "2024-01-01 11:50:00.000000")
    assert sorted(r.id for r in out.collect()) == [2, 3]


def test_extract_pushes_filter_into_parquet_scan(spark, tmp_root):
    src = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, ts timestamp_ntz")
    src.write.parquet(f"{tmp_root}/src")
    out = incremental_extract(spark.read.parquet(f"{tmp_root}/src"), "ts", "2023-12-31 00:00:00", columns=["id", "ts"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan


def test_extract_full_when_no_watermark_and_projection(spark):
    src = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))], "id int, x string, ts timestamp_ntz")
    out = incremental_extract(src, "ts", None, columns=["id", "ts"])
    assert out.columns == ["id", "ts"] and out.count() == 1


def test_soft_deleted_rows_kept_or_dropped(spark):
    src = spark.createDataFrame([(1, "true"), (2, "false"), (3, None)], "id int, IsDeleted string")
    src = src.withColumn("ts", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    kept = incremental_extract(src, "ts", None, deleted="IsDeleted", include_deleted=True)
    assert kept.count() == 3
    dropped = incremental_extract(src, "ts", None, deleted="IsDeleted", include_deleted=False)
    assert sorted(r.id for r in dropped.collect()) == [2, 3]
    flagged = incremental_extract(src, "ts", None, deleted=F.col("id") == 1, deleted_alias="del")
    assert {r.id: r["del"] for r in flagged.collect()} == {1: "true", 2: "false", 3: "false"}


def test_empty_short_circuit(spark):
    src = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, ts timestamp_ntz")
    assert is_empty(incremental_extract(src, "ts", "2024-01-01 00:00:00"))
    assert not is_empty(incremental_extract(src, "ts", "2023-01-01 00:00:00"))
