import glob
import os

from tidemark.sinks.table import (
    compact_table,
    partition_dir_name,
    stage_overwrite,
    upsert_table,
    write_partitioned,
)
from tidemark.sources.tables import read_partitioned, read_table

SCHEMA = "id int, v string, part string"


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "v", "part").collect())


def test_stage_overwrite_replaces_all_and_keeps_text_partition(spark, tmp_root):
    p = f"{tmp_root}/stage"
    a = spark.createDataFrame([(1, "x", "202401"), (2, "y", "202402")], SCHEMA)
    b = spark.createDataFrame([(3, "z", "202403")], SCHEMA)
    stage_overwrite(a, p, "part")
    back = stage_overwrite(b, p, "part")
    assert rows(back) == [(3, "z", "202403")]
    assert back.schema["part"].dataType.simpleString() == "string"
    assert read_partitioned(spark, p, "part").schema["part"].dataType.simpleString() == "string"


def test_composite_upsert_touches_only_source_partitions(spark, tmp_root):
    p = f"{tmp_root}/main"
    tgt = spark.createDataFrame([(1, "a", "202401"), (2, "b", "202402"), (3, "c", "202403")], SCHEMA)
    write_partitioned(tgt, p, "part", dynamic=False)
    before = set(glob.glob(f"{p}/part=202401/*.parquet"))
    src = spark.createDataFrame([(2, "B", "202402"), (4, "d", "202402"), (5, None, None)], SCHEMA)
    res = upsert_table(src, p, ["id"], "part")
    assert sorted(res.touched, key=str) == sorted(["202402", None], key=str)
    assert set(glob.glob(f"{p}/part=202401/*.parquet")) == before      # untouched files stay
    got = rows(read_table(spark, p, src.schema))
    assert got == [(1, "a", "202401"), (2, "B", "202402"), (3, "c", "202403"), (4, "d", "202402"), (5, None, None)]
    # a NULL partition key matches on the next run instead of being inserted again
    upsert_table(spark.createDataFrame([(5, "e", None)], SCHEMA), p, ["id"], "part")
    got = rows(read_table(spark, p, src.schema))
    assert (5, "e", None) in got and len(got) == 5


def test_key_only_upsert_moves_rows_and_drops_emptied_partitions(spark, tmp_root):
    p = f"{tmp_root}/main"
    tgt = spark.createDataFrame([(1, "a", "202401"), (2, "b", "202402"), (3, "c", "202402")], SCHEMA)
    write_partitioned(tgt, p, "part", dynamic=False)
    src = spark.createDataFrame([(1, "a2", "202403"), (2, "b2", "202403")], SCHEMA)
    res = upsert_table(src, p, ["id"], "part", key_only=True)
    assert res.emptied == ["202401"]
    assert not os.path.exists(f"{p}/part=202401")
    got = rows(read_table(spark, p, src.schema))
    assert got == [(1, "a2", "202403"), (2, "b2", "202403"), (3, "c", "202402")]


def test_first_upsert_creates_table(spark, tmp_root):
    p = f"{tmp_root}/main"
    src = spark.createDataFrame([(1, "a", "202401")], SCHEMA)
    res = upsert_table(src, p, ["id"], "part")
    assert res.created and rows(read_table(spark, p, src.schema)) == [(1, "a", "202401")]


def test_upsert_twice_is_once(spark, tmp_root):
    p = f"{tmp_root}/main"
    tgt = spark.createDataFrame([(i, "t", f"2024{i % 3:02d}") for i in range(30)], SCHEMA)
    write_partitioned(tgt, p, "part", dynamic=False)
    src = spark.createDataFrame([(i, "s", f"2024{i % 3:02d}") for i in range(20, 40)], SCHEMA)
    upsert_table(src, p, ["id"], "part")
    once = rows(read_table(spark, p, src.schema))
    upsert_table(src, p, ["id"], "part")
    assert rows(read_table(spark, p, src.schema)) == once
    assert len(once) == 40


def test_compaction_reduces_files_and_keeps_rows(spark, tmp_root):
    p = f"{tmp_root}/t"
    df = spark.createDataFrame([(i, "v", f"2024{i % 4:02d}") for i in range(400)], SCHEMA)
    write_partitioned(df.repartition(20), p, "part", dynamic=False, rebalance=False)
    n_before = len(glob.glob(f"{p}/part=*/*.parquet"))
    out = compact_table(spark, p, "part", df.schema)
    n_after = len(glob.glob(f"{p}/part=*/*.parquet"))
    assert n_after < n_before and n_after <= 8
    assert rows(out) == rows(df)


def test_compaction_of_some_partitions_only(spark, tmp_root):
    p = f"{tmp_root}/t"
    df = spark.createDataFrame([(i, "v", f"2024{i % 2:02d}") for i in range(100)], SCHEMA)
    write_partitioned(df.repartition(10), p, "part", dynamic=False, rebalance=False)
    other = set(glob.glob(f"{p}/part=202401/*.parquet"))
    compact_table(spark, p, "part", df.schema, partitions=["202400"])
    assert set(glob.glob(f"{p}/part=202401/*.parquet")) == other
    assert len(glob.glob(f"{p}/part=202400/*.parquet")) < 10


def test_partition_dir_names():
    assert partition_dir_name("p", None) == "p=__HIVE_DEFAULT_PARTITION__"
    assert partition_dir_name("p", "a/b:c") == "p=a%2Fb%3Ac"
    assert partition_dir_name("p", 202401) == "p=202401"


def test_upsert_counts_and_observed_max(spark, tmp_root):
    p = f"{tmp_root}/main"
    schema = "id int, v string, part string, m string"
    tgt = spark.createDataFrame([(1, "a", "202401", "2024-01-05 00:00:00"),
                                 (2, "b", "202402", "2024-02-05 00:00:00")], schema)
    first = upsert_table(tgt, p, ["id"], "part", count_changes=True, observe_max_of="m")
    assert (first.created, first.updated, first.inserted) == (True, 0, 2)
    assert first.max_modified == "2024-02-05 00:00:00.000000"
    src = spark.createDataFrame([(2, "B", "202402", "2024-02-06 00:00:00"),
                                 (3, "c", "202402", "2024-02-07 00:00:00")], schema)
    res = upsert_table(src, p, ["id"], "part", count_changes=True, observe_max_of="m")
    assert (res.updated, res.inserted) == (1, 1)
    assert res.max_modified == "2024-02-07 00:00:00.000000"
    moved = spark.createDataFrame([(1, "A", "202403", "2024-03-01 00:00:00")], schema)
    res = upsert_table(moved, p, ["id"], "part", key_only=True, count_changes=True)
    assert (res.updated, res.inserted, res.emptied) == (1, 0, ["202401"])


def test_catalog_table_follows_upserts(spark, tmp_root):
    from tidemark.sinks.catalog import create_table, create_table_sql

    p = f"{tmp_root}/cat"
    df = spark.createDataFrame([(1, "a", "202401"), (2, "b", "202402")], SCHEMA)
    ddl = create_table_sql("tm_cat", df.schema, "part", p)
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS tm_cat (`id` int, `v` string, `part` string) USING parquet")
    create_table(spark, "tm_cat", df.schema, "part", p)
    upsert_table(df, p, ["id"], "part", table="tm_cat")
    assert spark.table("tm_cat").count() == 2
    moved = spark.createDataFrame([(1, "a", "202403")], SCHEMA)
    upsert_table(moved, p, ["id"], "part", key_only=True, table="tm_cat")
    assert rows(spark.table("tm_cat")) == [(1, "a", "202403"), (2, "b", "202402")]
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS tm_cat").collect())
    assert parts == ["part=202402", "part=202403"]


def test_repeated_upserts_keep_files_per_partition_bounded(spark, tmp_root):
    import collections

    p = f"{tmp_root}/main"
    tgt = spark.createDataFrame([(i, "t", f"2024{i % 4:02d}") for i in range(200)], SCHEMA)
    write_partitioned(tgt, p, "part", dynamic=False)
    compactions = 0
    for run in range(5):
        src = spark.createDataFrame([(i, f"r{run}", f"2024{i % 4:02d}") for i in range(run * 10, run * 10 + 30)],
                                    SCHEMA)
        res = upsert_table(src, p, ["id"], "part", source_rows=30, compact_over=3)
        compactions += bool(res.compacted)
        per_part = collections.Counter(os.path.basename(os.path.dirname(f))
                                       for f in glob.glob(f"{p}/part=*/*.parquet"))
        assert max(per_part.values()) <= 3
    assert compactions >= 1
    got = dict((r.id, r.v) for r in read_table(spark, p, tgt.schema).collect())
    assert len(got) == 200 and got[45] == "r4" and got[5] == "r0" and got[199] == "t"


def test_hot_partition_is_split_across_writers(spark, tmp_root):
    p = f"{tmp_root}/hot"
    from pyspark.sql import functions as F

    rows = [(i, "", "202401" if i % 3 == 0 else f"2024{i % 12 + 1:02d}") for i in range(6000)]
    # incompressible values, so the shuffle sizes are real
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_partitioned(df.repartition(8), p, "part", dynamic=False)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = glob.glob(f"{p}/part=202401/*.parquet")
    assert len(hot_files) > 1                       # the third of all rows did not go to one task
    assert read_table(spark, p, df.schema).count() == 6000


def test_table_exists_on_missing_and_empty_folders(spark, tmp_root):
    from tidemark.sources.tables import table_exists

    assert not table_exists(spark, f"{tmp_root}/missing")
    os.makedirs(f"{tmp_root}/empty")
    assert not table_exists(spark, f"{tmp_root}/empty")
    spark.createDataFrame([(1, "a", "x")], SCHEMA).write.parquet(f"{tmp_root}/full")
    assert table_exists(spark, f"{tmp_root}/full")
