import random

import pytest
from pyspark.sql import functions as F

from tidemark.sinks.key_index import KeyIndex
from tidemark.sinks.table import partition_dir_name, upsert_table, write_partitioned
from tidemark.sources.tables import read_table

SCHEMA = "id long, v string, part string"
PARTS = ["202401", "202402", "a=b/c%", "202403", None, "x y"]


def rows(spark, path, schema):
    return sorted((tuple(r) for r in read_table(spark, path, schema).select("id", "v", "part").collect()), key=str)


def holders(data, wanted):
    return {partition_dir_name("part", p) for i, _, p in data if i in wanted}


@pytest.mark.parametrize("seed", range(4))
def test_no_partition_of_a_full_probe_is_missing(spark, tmp_root, seed):
    rng = random.Random(seed)
    data = [(rng.choice([None, rng.randrange(5000), rng.randrange(10**12)]), f"r{k}", rng.choice(PARTS)) for k in range(900)]
    df = spark.createDataFrame(data, SCHEMA)
    write_partitioned(df, f"{tmp_root}/t", "part", dynamic=False)
    index = KeyIndex(f"{tmp_root}/i", f"{tmp_root}/t", ["id"], "part")
    stored = read_table(spark, f"{tmp_root}/t", df.schema)
    index.refresh(stored)
    for size in (0, 1, 3, 200):
        wanted = rng.sample([r[0] for r in data], size) + [rng.randrange(10**12) for _ in range(3)]
        source = spark.createDataFrame([(i, "s", "p") for i in wanted], SCHEMA)
        got = {r[0] for r in index.candidates(source).collect()}
        assert got >= holders(data, set(wanted))
    # A key outside of all ranges finds nothing; a changed partition always counts.
    none = spark.createDataFrame([(-5, "s", "p")], SCHEMA)
    assert index.candidates(none).collect() == []
    spark.createDataFrame([(-5, "late", "202402")], SCHEMA).write.mode("append").partitionBy("part").parquet(f"{tmp_root}/t")
    assert [r[0] for r in index.candidates(none).collect()] == ["part=202402"]


@pytest.mark.parametrize("seed", range(2))
def test_upserts_with_and_without_index_agree(spark, tmp_root, seed):
    rng = random.Random(10 + seed)
    data = {k: (k, f"r{k}", rng.choice(PARTS)) for k in [*range(0, 400, 2), None]}
    df = spark.createDataFrame(list(data.values()), SCHEMA)
    plain, fast = f"{tmp_root}/plain", f"{tmp_root}/fast"
    write_partitioned(df, plain, "part", dynamic=False)
    write_partitioned(df, fast, "part", dynamic=False)
    for step in range(3):
        keys = rng.sample(range(420), 15) + [None]
        change = [(k, f"s{step}-{k}", rng.choice(PARTS[:4])) for k in keys]
        source = spark.createDataFrame(change, SCHEMA)
        a = upsert_table(source, plain, ["id"], "part", key_only=True, count_changes=True)
        b = upsert_table(source, fast, ["id"], "part", key_only=True, count_changes=True, index_path=f"{tmp_root}/idx")
        data.update({r[0]: r for r in change})
        assert rows(spark, plain, df.schema) == rows(spark, fast, df.schema) == sorted(data.values(), key=str)
        assert (a.updated, a.inserted, sorted(a.emptied, key=str)) == (b.updated, b.inserted, sorted(b.emptied, key=str))
        assert (b.probed is None) == (step == 0)  # the first upsert builds the index


def test_probe_reads_only_where_a_key_may_be(spark, tmp_root):
    data = spark.range(20000).select("id", F.lit("v").alias("v"), F.concat(F.lit("p"), (F.col("id") % 20).cast("string")).alias("part"))
    write_partitioned(data, f"{tmp_root}/t", "part", dynamic=False)
    KeyIndex(f"{tmp_root}/i", f"{tmp_root}/t", ["id"], "part").refresh(read_table(spark, f"{tmp_root}/t", data.schema))
    source = spark.createDataFrame([(45, "new", "p6"), (10**9, "new", "p7")], SCHEMA)
    res = upsert_table(source, f"{tmp_root}/t", ["id"], "part", key_only=True, index_path=f"{tmp_root}/i")
    # Id 45 was in p5; the ranges of all partitions hold it, so only the filters tell.
    assert "p5" in res.probed and len(res.probed) <= 3 and res.probe_rows == 1000 * len(res.probed)
    got = read_table(spark, f"{tmp_root}/t", data.schema)
    assert got.count() == 20001 and [r.part for r in got.where("id = 45").collect()] == ["p6"]
    # The refreshed entries answer the next upsert.
    res = upsert_table(spark.createDataFrame([(45, "again", "p1")], SCHEMA), f"{tmp_root}/t", ["id"], "part", key_only=True, index_path=f"{tmp_root}/i")
    assert "p6" in res.probed and "p5" not in res.probed
    assert read_table(spark, f"{tmp_root}/t", data.schema).where("id = 45").count() == 1


def test_composite_and_text_keys(spark, tmp_root):
    data = [(k, f"t{k % 7}", f"2024{k % 4:02d}") for k in range(200)]
    df = spark.createDataFrame(data, SCHEMA)
    write_partitioned(df, f"{tmp_root}/t", "part", dynamic=False)
    index = KeyIndex(f"{tmp_root}/i", f"{tmp_root}/t", ["v", "id"], "part")
    index.refresh(read_table(spark, f"{tmp_root}/t", df.schema))
    source = spark.createDataFrame([(5, "t5", "z"), (5, "t6", "z")], SCHEMA)
    got = {r[0] for r in index.candidates(source).collect()}
    assert "part=202401" in got and len(got) <= 2
