"""Compaction by bin packing: only small files are rewritten.

The files of the table are listed as rows; those below ``small_bytes`` are
packed per partition into bins of ``target_bytes``, largest first, each into
the first bin with room.  A bin of two files or more becomes one new file; a
sound file, and a small one that found no company, keeps its name and bytes.

The new files are written to a hidden folder first.  Then, bin by bin, the new
file is moved into its partition and the bin's old files are deleted.  The
plan is kept as a table beside them, so :func:`finish` completes a run that
was lost in between.  Parquet has no transaction log: a reader that lists a
partition while its bin is exchanged may see that bin's rows twice.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import data_files, folder_of, plain_path

WORK = "_compaction"
#: File names that may be broadcast to the rewrite.
BROADCAST_FILES = 200_000


def first_fit_decreasing(sizes: list[int], target: int) -> list[int]:
    """Bin of each size: largest first, into the first bin with room."""
    room = np.zeros(len(sizes) or 1, np.int64)
    out, used = [0] * len(sizes), 0
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = np.flatnonzero(room[:used] >= sizes[k])
        if not len(fits):
            room[used] = target
            used += 1
            fits = [used - 1]
        out[k] = int(fits[0])
        room[out[k]] -= sizes[k]
    return out


def plan_bins(spark: SparkSession, path: str, target_bytes: int, small_bytes: int) -> DataFrame:
    """folder, file, file_path, bin of the files that will be rewritten."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("file")
        pdf["bin"] = first_fit_decreasing(pdf.length.tolist(), target_bytes)
        return pdf[pdf.groupby("bin")["bin"].transform("size") > 1][["folder", "file", "file_path", "bin"]]

    hidden = F.col("file_path").contains(f"/{WORK}/")
    small = data_files(spark, path).where(~hidden & (F.col("length") < small_bytes)).select("folder", "file", "file_path", "length")
    return small.groupBy("folder").applyInPandas(pack, "folder string, file string, file_path string, bin long")


def compact_bins(spark: SparkSession, path: str, partition_col: str, schema, target_bytes: int = 256 << 20,
                 small_bytes: int = 64 << 20, before_exchange=None) -> int:
    """Pack the small files of the table at ``path``; returns the number of new files."""
    finish(spark, path, partition_col)
    work = f"{path.rstrip('/')}/{WORK}/{uuid.uuid4().hex[:12]}"
    plan_bins(spark, path, target_bytes, small_bytes).write.parquet(f"{work}/plan")
    plan = spark.read.parquet(f"{work}/plan")
    # Names of the small files only, as any scan of them holds them on the driver.
    files = [r[0] for r in plan.select("file_path").collect()]
    if files:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*files)
        # A task names its files alike in every folder, so only both names tell files apart.
        uri = F.col("_metadata.file_path")
        rows = rows.withColumns({"__folder": folder_of(uri), "__file": F.element_at(F.split(plain_path(uri), "/"), -1)})
        bins = plan.select(F.col("folder").alias("__folder"), F.col("file").alias("__file"), F.col("bin").alias("__bin"))
        bins = F.broadcast(bins) if len(files) <= BROADCAST_FILES else bins
        packed = rows.join(bins, ["__folder", "__file"]).drop("__folder", "__file")
        packed.hint("rebalance", partition_col, "__bin").write.partitionBy(partition_col, "__bin").parquet(f"{work}/new")
    _touch(spark, f"{work}/_READY")
    if before_exchange is not None:
        before_exchange()
    return finish(spark, path, partition_col)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # Hadoop FileSystem handle
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p).close()


def finish(spark: SparkSession, path: str, partition_col: str) -> int:
    """Exchange the files of every prepared run, also of one lost half-way; unprepared runs are dropped."""
    fs, root = _fs(spark, f"{path.rstrip('/')}/{WORK}")
    if not fs.exists(root):
        return 0
    made = 0
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for run in [s.getPath() for s in fs.listStatus(root)]:
        work = run.toString()
        if fs.exists(at(f"{work}/_READY")):
            old: dict[tuple[str, int], list[str]] = {}
            for r in spark.read.parquet(f"{work}/plan").collect():
                old.setdefault((r.folder, r.bin), []).append(r.file)
            for (folder, k), files in old.items():
                new = at(f"{work}/new/{folder}/__bin={k}")
                home = f"{path.rstrip('/')}/{folder}"
                if fs.exists(new):
                    for n, s in enumerate(sorted(x.getPath().toString() for x in fs.listStatus(new) if x.getPath().getName().endswith(".parquet"))):
                        # A fixed name: a move that was done before is not done twice.
                        fs.rename(at(s), at(f"{home}/packed-{run.getName()}-{k}-{n}.parquet"))
                        made += 1
                for f in files:
                    fs.delete(at(f"{home}/{f}"), False)
        fs.delete(run, True)
    return made
