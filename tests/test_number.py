from pyspark.sql import functions as F

from tidemark.operators.number import (
    batch_summary,
    row_number_global,
    row_number_ranged,
    slice_ids,
)


def test_ranged_equals_global_window_on_unique_keys(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 as k", "id as v")
    a = {r.k: r.rowNum for r in row_number_ranged(df, ["k"]).collect()}
    b = {r.k: r.rowNum for r in row_number_global(df, ["k"]).collect()}
    assert a == b


def test_ranged_ascending(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    got = sorted((r.k, r.rowNum) for r in row_number_ranged(df, ["k"], descending=False).collect())
    assert got == [(1, 1), (2, 2), (3, 3)]


def test_duplicates_and_hot_key_get_a_stable_permutation(spark):
    # a third of the rows share one key
    df = spark.range(0, 3000).selectExpr("case when id % 3 = 0 then 42 else id end as k", "id as v")
    out = row_number_ranged(df, ["k"], num_partitions=8)
    got = [tuple(r) for r in out.collect()]
    assert sorted(r[2] for r in got) == list(range(1, 3001))
    # descending key order holds
    by_num = sorted(got, key=lambda r: r[2])
    keys = [r[0] for r in by_num]
    assert keys == sorted(keys, reverse=True)
    # the hot key is spread over several partitions
    laid = (df.withColumn("__tb", F.xxhash64("k", "v"))
              .repartitionByRange(8, F.col("k").desc(), "__tb")
              .where("k = 42").select(F.spark_partition_id().alias("p")).distinct().count())
    assert laid > 1
    again = {(r[0], r[1]): r[2] for r in row_number_ranged(df, ["k"], num_partitions=5).collect()}
    assert again == {(r[0], r[1]): r[2] for r in got}


def test_slices_partition_the_rows(spark):
    for n_rows in (1, 9, 10, 11, 20):
        df = spark.range(0, n_rows).withColumnRenamed("id", "k")
        numbered = row_number_ranged(df, ["k"])
        summary = sorted(tuple(r) for r in batch_summary(numbered, 10).collect())
        assert sum(s[1] for s in summary) == n_rows
        assert summary[0][2] == 1 and summary[-1][3] == n_rows
        ids = slice_ids(numbered, 10).select("batch_id").distinct().count()
        assert ids == (n_rows + 9) // 10
