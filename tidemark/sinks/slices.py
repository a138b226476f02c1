"""Sliced sink with a commit protocol.

``df.write.format("tidemark_slices")`` publishes numbered rows in slices.  Every
task stages its rows, one file a slice, in a folder that readers do not look
at, and reports the files to the driver.  ``commit`` then publishes all slices
in one step: it renames one manifest into place that names the files of the
tasks that succeeded.  ``abort`` deletes what was staged.  So a failed task
leaves nothing, a task that ran twice counts once, and a rerun under the same
``run`` replaces its own manifest with one of the same rows.

Options: ``path``, ``run`` (name of the publication), ``slice`` (name of the
slice column, a whole number) and ``attempt`` (name of the staged folder, made
up where not given).  Files go through Arrow's file systems, so
``path`` may be any location that Arrow, the driver and all executors reach.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "tidemark_slices"
MANIFESTS, STAGED = "_manifests", "_staged"
#: Tasks that are being stopped may still write while an abort deletes.
ABORT_TRIES, ABORT_WAIT = 25, 0.2


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Staged(WriterCommitMessage):
    files: dict  # slice -> [(file, rows)]


class SliceWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str, column: str, attempt: str | None = None):
        self.path, self.run, self.column = path.rstrip("/"), run, column
        self.attempt = attempt or uuid.uuid4().hex[:12]
        # Only the driver makes the folder: a task that starts after an abort has none to write to.
        fs, root = _store(self.path)
        fs.create_dir(f"{root}/{self._folder()}", recursive=True)

    def _folder(self) -> str:
        return f"{STAGED}/{self.run}/{self.attempt}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """Stage a task's rows; a file of each slice stays open until the task ends."""
        fs, root = _store(self.path)
        task, open_files, rows = uuid.uuid4().hex[:12], {}, {}
        for batch in iterator:
            numbers = batch.column(self.column)
            if numbers.null_count:
                raise ValueError(f"a row has no {self.column}")
            for k in pc.unique(numbers).to_pylist():
                part = batch.filter(pc.equal(numbers, k))
                if k not in open_files:
                    name = f"{self._folder()}/slice-{k}-{task}.parquet"
                    open_files[k] = (name, pq.ParquetWriter(fs.open_output_stream(f"{root}/{name}"), part.schema))
                open_files[k][1].write_batch(part)
                rows[k] = rows.get(k, 0) + part.num_rows
        for _, w in open_files.values():
            w.close()
        return Staged({k: [(name, rows[k])] for k, (name, _) in open_files.items()})

    def commit(self, messages: list) -> None:
        """Publish all slices: one rename."""
        fs, root = _store(self.path)
        files: dict = {}
        for m in messages:
            for k, parts in (m.files if m is not None else {}).items():
                files.setdefault(str(k), []).extend(parts)
        fs.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        made = f"{root}/{MANIFESTS}/.{self.run}-{self.attempt}"
        with fs.open_output_stream(made) as out:
            out.write(json.dumps({"run": self.run, "slices": files}, sort_keys=True).encode())
        fs.move(made, f"{root}/{MANIFESTS}/{self.run}.json")

    def abort(self, messages: list) -> None:
        """Delete what the tasks of this attempt staged."""
        fs, root = _store(self.path)
        folder = f"{root}/{self._folder()}"
        for k in range(ABORT_TRIES):
            try:
                if fs.get_file_info(folder).type == pafs.FileType.NotFound:
                    return
                fs.delete_dir(folder)
            except OSError:
                if k == ABORT_TRIES - 1:
                    raise
            time.sleep(ABORT_WAIT)


class SliceSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        raise ValueError(f"{NAME} is a sink; read with read_slices()")

    def writer(self, schema: StructType, overwrite: bool) -> SliceWriter:
        return SliceWriter(self.options["path"], self.options["run"], self.options["slice"], self.options.get("attempt"))


def publish_slices(df: DataFrame, path: str, run: str, slice_col: str) -> None:
    """Publish ``df`` as the slices of ``run``; rows of one slice may come from many tasks."""
    spark = df.sparkSession
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SliceSink)
    attempt = uuid.uuid4().hex[:12]
    out = df.write.format(NAME).mode("append").option("path", path).option("run", run).option("slice", slice_col)
    try:
        out.option("attempt", attempt).save()
    except Exception:
        # Spark's own abort may fail, or end before its last task.
        SliceWriter(path, run, slice_col, attempt).abort([])
        raise


def manifest(path: str, run: str) -> dict | None:
    """Slices of a published run: ``{slice: [(file, rows), …]}``; None before it is published."""
    fs, root = _store(path.rstrip("/"))
    at = f"{root}/{MANIFESTS}/{run}.json"
    if fs.get_file_info(at).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(at) as f:
        return json.loads(f.read())["slices"]


def read_slices(spark: SparkSession, path: str, run: str, schema: StructType, slices: list | None = None) -> DataFrame:
    """Rows of a published run (of some slices); an unpublished run has none."""
    found = manifest(path, run) or {}
    files = [f"{path.rstrip('/')}/{name}" for k, parts in found.items() if slices is None or int(k) in slices for name, _ in parts]
    # Staged folders begin with "_", which a folder scan hides; files are named one by one.
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
