import glob
import os
import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.sinks.compact import compact_bins, finish, first_fit_decreasing
from tidemark.sinks.slices import STAGED, SliceWriter, manifest, publish_slices, read_slices
from tidemark.sources.tables import read_table

SCHEMA = "id long, v string, part string"


def test_first_fit_decreasing():
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 70) for _ in range(rng.randint(0, 40))]
        bins = first_fit_decreasing(sizes, 100)
        held = {}
        for s, b in zip(sizes, bins, strict=True):
            held[b] = held.get(b, 0) + s
        assert all(v <= 100 for v in held.values())
        assert sum(1 for v in held.values() if v <= 50) <= 1  # two half-empty bins would be one
    assert first_fit_decreasing([60, 50, 40, 30], 100) == [0, 1, 0, 1]


def table(spark, path):
    df = spark.range(400).select("id", F.concat(F.lit("v"), "id").alias("v"), F.concat(F.lit("p "), (F.col("id") % 3).cast("string")).alias("part"))
    df.repartition(6).write.partitionBy("part").parquet(path)
    big = spark.range(10**6, 10**6 + 30000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("p 0").alias("part"))
    big.coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    return df.unionByName(big)


def listing(path):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/part=*/*.parquet")}


def got(spark, path, schema):
    return sorted(tuple(r) for r in read_table(spark, path, schema).select("id", "v", "part").collect())


def test_only_small_files_are_rewritten(spark, tmp_root):
    path = f"{tmp_root}/t"
    df = table(spark, path)
    want, before = sorted(tuple(r) for r in df.collect()), listing(path)
    sound = {f for f, n in before.items() if n >= 20_000}
    assert compact_bins(spark, path, "part", df.schema, target_bytes=10**6, small_bytes=20_000) == 3
    after = listing(path)
    assert sound and sound <= set(after) and len(after) == len(sound) + 3 and got(spark, path, df.schema) == want
    assert compact_bins(spark, path, "part", df.schema, target_bytes=10**6, small_bytes=20_000) == 0  # nothing left to pack
    assert listing(path) == after


def test_a_lost_compaction_is_finished(spark, tmp_root):
    path = f"{tmp_root}/t"
    df = table(spark, path)
    want = got(spark, path, df.schema)

    def lost():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        compact_bins(spark, path, "part", df.schema, target_bytes=10**6, small_bytes=20_000, before_exchange=lost)
    assert got(spark, path, df.schema) == want
    assert finish(spark, path, "part") == 3 and got(spark, path, df.schema) == want and finish(spark, path, "part") == 0


def numbered(spark, n=500):
    return spark.range(n).select("id", F.concat(F.lit("v"), "id").alias("v"), (F.col("id") / 100).cast("int").alias("slice"))


def test_slices_are_published_in_one_step(spark, tmp_root):
    df = numbered(spark).repartition(4)
    assert manifest(tmp_root, "r1") is None and read_slices(spark, tmp_root, "r1", df.schema).count() == 0
    publish_slices(df, tmp_root, "r1", "slice")
    want = sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, read_slices(spark, tmp_root, "r1", df.schema).collect())) == want
    assert {k: sum(n for _, n in v) for k, v in manifest(tmp_root, "r1").items()} == {str(k): 100 for k in range(5)}
    assert sorted(map(tuple, read_slices(spark, tmp_root, "r1", df.schema, slices=[1, 4]).collect())) == [r for r in want if r[2] in (1, 4)]
    publish_slices(df, tmp_root, "r1", "slice")  # a rerun gives the same rows
    assert sorted(map(tuple, read_slices(spark, tmp_root, "r1", df.schema).collect())) == want


def test_a_failed_task_leaves_nothing(spark, tmp_root):
    df = numbered(spark)
    publish_slices(df, tmp_root, "r1", "slice")
    kept = sorted(glob.glob(f"{tmp_root}/{STAGED}/**/*.parquet", recursive=True))
    bad = df.withColumn("slice", F.when(F.col("id") != 477, F.col("slice"))).repartition(3)
    with pytest.raises(Exception, match="no slice"):
        publish_slices(bad, tmp_root, "r1", "slice")
    with pytest.raises(Exception, match="no slice"):
        publish_slices(bad, tmp_root, "r2", "slice")
    assert manifest(tmp_root, "r2") is None
    assert sorted(glob.glob(f"{tmp_root}/{STAGED}/**/*.parquet", recursive=True)) == kept
    assert sorted(map(tuple, read_slices(spark, tmp_root, "r1", df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_abort_outlasts_tasks_that_still_write(tmp_root, monkeypatch):
    from tidemark.sinks import slices

    class Busy:
        left = 2

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def delete_dir(self, path):
            if Busy.left:
                Busy.left -= 1
                raise OSError(39, "Directory not empty")
            self.fs.delete_dir(path)

    store = slices._store
    monkeypatch.setattr(slices, "_store", lambda path: (Busy(store(path)[0]), store(path)[1]))
    w = SliceWriter(tmp_root, "r", "slice")
    folder = f"{tmp_root}/{w._folder()}"
    store(tmp_root)[0].create_dir(folder, recursive=True)
    open(f"{folder}/slice-0-x.parquet", "w").close()
    w.abort([])
    assert Busy.left == 0 and not glob.glob(f"{folder}*")


def test_a_task_that_starts_after_the_abort_stages_nothing(tmp_root):
    import pyarrow as pa

    batch = pa.record_batch([pa.array([1, 2]), pa.array([0, 1])], names=["id", "slice"])
    w = SliceWriter(tmp_root, "r", "slice")
    w.write(iter([batch]))
    w.abort([])
    with pytest.raises(OSError):
        w.write(iter([batch]))
    assert not glob.glob(f"{tmp_root}/{STAGED}/**/*.parquet", recursive=True)


def test_a_failed_abort_leaves_nothing(spark, tmp_root, monkeypatch):
    def broken(self, messages):
        raise RuntimeError("abort failed")

    kept = SliceWriter.abort
    monkeypatch.setattr(SliceWriter, "abort", broken)
    save = DataFrameWriter.save

    def then_mend(self, *args, **kwargs):
        try:
            return save(self, *args, **kwargs)
        finally:
            monkeypatch.setattr(SliceWriter, "abort", kept)

    monkeypatch.setattr(DataFrameWriter, "save", then_mend)
    bad = numbered(spark).withColumn("slice", F.when(F.col("id") != 477, F.col("slice"))).repartition(3)
    with pytest.raises(Exception, match="no slice"):
        publish_slices(bad, tmp_root, "r1", "slice")
    assert manifest(tmp_root, "r1") is None
    assert not glob.glob(f"{tmp_root}/{STAGED}/**/*.parquet", recursive=True)


def test_a_task_that_ran_twice_counts_once(spark, tmp_root):
    import pyarrow as pa

    batch = pa.record_batch([pa.array([1, 2]), pa.array([0, 1])], names=["id", "slice"])
    w = SliceWriter(tmp_root, "r", "slice")
    w.write(iter([batch]))  # its message is lost
    w.commit([w.write(iter([batch])), None])
    assert sorted(map(tuple, read_slices(spark, tmp_root, "r", spark.createDataFrame([], "id long, slice long").schema).collect())) == [(1, 0), (2, 1)]


def test_stream_lookback_lets_each_row_pass_once(spark, tmp_root):
    from tidemark.streaming.lookback import drop_redelivered

    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000) + s)
    rows = spark.range(0, 4000, 10).select("id", at(F.col("id")).alias("ts"))
    for k in range(4):
        lo, hi = k * 1000, (k + 1) * 1000
        # Every third row of a pull's last 300 s shows up in the next pull only.
        late = (F.col("id") >= hi - 300) & (F.col("id") % 30 == 0) & F.lit(k < 3)
        rows.where((F.col("id") >= lo - 600) & (F.col("id") < hi) & ~late).coalesce(1).write.mode("append").parquet(f"{tmp_root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_root}/in")
    q = (drop_redelivered(stream, ["id", "ts"], "ts").writeStream.format("parquet").option("path", f"{tmp_root}/out")
         .option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_root}/out").collect()) == list(range(0, 4000, 10))
