"""Connector scan: a paged object store read as a Spark data source.

``spark.read.format("tidemark_pages")`` reads an object that a remote system
hands out in pages.  Options: ``path`` (root of the exported objects),
``object``, ``version`` (the API version that served the pages), ``columns``
(the query's columns, comma separated; all, if absent) and ``queryAll``
(``true`` adds the soft-deleted records, whose flag column stays readable).

Layout below ``path``: ``<object>/v<version>/<page>.parquet``, one page a
file.  Each page is one input partition.  ``pushFilters`` hands the reader the
comparisons it can decide: a page whose statistics rule a comparison out is
not opened for rows, and the rest are applied to its rows before they leave
the reader.  Filters that it cannot decide stay with Spark.

Pages are opened by the tasks through Arrow's file systems, so ``path`` may be
any location that Arrow and all executors reach.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

NAME = "tidemark_pages"
DELETED = "is_deleted"
#: Comparison of each filter that the reader decides, by its class.
COMPARE = {GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal,
           EqualTo: pc.equal}


@dataclass
class Page(InputPartition):
    file: str
    filters: tuple = ()


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a location, with or without a scheme."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _typed(value, kind: pa.DataType) -> pa.Scalar:
    if isinstance(value, dt.datetime) and pa.types.is_timestamp(kind) and kind.tz is None:
        value = value.replace(tzinfo=None)
    return pa.scalar(value, kind)


class PagesReader(DataSourceReader):
    def __init__(self, folder: str, schema: StructType, query_all: bool):
        self.folder, self.schema, self.query_all, self.filters = folder, schema, query_all, []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802 - Spark's name
        """Keep the comparisons on plain columns; give the others back."""
        names = {f.name for f in self.schema.fields}
        for f in filters:
            if len(f.attribute) == 1 and f.attribute[0] in names and type(f) in (*COMPARE, In, IsNotNull, IsNull):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Page]:
        """One partition a page that may hold rows."""
        fs, root = _store(self.folder)
        files = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(root)) if i.path.endswith(".parquet"))
        return [Page(f, tuple(self.filters)) for f in files] or [Page("")]

    def _ruled_out(self, stats: pq.Statistics | None, f: Filter, kind: pa.DataType) -> bool:
        if stats is None or not stats.has_min_max or type(f) not in COMPARE:
            return False
        low, high, value = (_typed(v, kind) for v in (stats.min, stats.max, f.value))
        if type(f) in (GreaterThan, GreaterThanOrEqual):
            return not COMPARE[type(f)](high, value).as_py()
        if type(f) in (LessThan, LessThanOrEqual):
            return not COMPARE[type(f)](low, value).as_py()
        return pc.less(value, low).as_py() or pc.greater(value, high).as_py()

    def _groups(self, page: pq.ParquetFile, filters: tuple) -> list[int]:
        """Row groups that the statistics do not rule out."""
        meta, keep = page.metadata, []
        at = {meta.schema.column(k).path: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            if not any(self._ruled_out(group.column(at[f.attribute[0]]).statistics, f, page.schema_arrow.field(f.attribute[0]).type)
                       for f in filters if f.attribute[0] in at):
                keep.append(g)
        return keep

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = _store(self.folder)
        kinds = to_arrow_schema(self.schema)
        with fs.open_input_file(partition.file) as f:
            page = pq.ParquetFile(f)
            used = list(dict.fromkeys([*kinds.names, *(x.attribute[0] for x in partition.filters), *([] if self.query_all else [DELETED])]))
            used = [c for c in used if c in page.schema_arrow.names]
            groups = self._groups(page, partition.filters)
            for batch in page.iter_batches(row_groups=groups, columns=used) if groups else ():
                batch = self._kept(batch, partition.filters)
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(n).cast(t) for n, t in zip(kinds.names, kinds.types, strict=True)], schema=kinds)

    def _kept(self, batch: pa.RecordBatch, filters: tuple) -> pa.RecordBatch:
        mask = None
        if not self.query_all and DELETED in batch.schema.names:
            mask = pc.not_equal(pc.fill_null(batch.column(DELETED).cast(pa.string()), "false"), "true")
        for f in filters:
            c = batch.column(f.attribute[0])
            if type(f) is IsNull:
                m = c.is_null()
            elif type(f) is IsNotNull:
                m = c.is_valid()
            elif type(f) is In:
                m = pc.is_in(c, pa.array([_typed(v, c.type).as_py() for v in f.value], c.type))
            else:
                m = pc.fill_null(COMPARE[type(f)](c, _typed(f.value, c.type)), False)
            mask = m if mask is None else pc.and_(mask, m)
        return batch if mask is None else batch.filter(mask)


class PagesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _folder(self) -> str:
        missing = [o for o in ("path", "object", "version") if not self.options.get(o)]
        if missing:
            raise ValueError(f"options are missing: {missing}")
        return f"{self.options['path'].rstrip('/')}/{self.options['object']}/v{self.options['version']}"

    def schema(self) -> StructType:
        fs, root = _store(self._folder())
        files = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(root)) if i.path.endswith(".parquet"))
        if not files:
            raise ValueError(f"no pages below {root}: give the schema")
        with fs.open_input_file(files[0]) as f:
            whole = from_arrow_schema(pq.read_schema(f))
        columns = [c.strip() for c in (self.options.get("columns") or "").split(",") if c.strip()]
        absent = [c for c in columns if c not in whole.names]
        if absent:
            raise ValueError(f"the object has no columns {absent}")
        return StructType([whole[c] for c in columns or whole.names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagesReader(self._folder(), schema, str(self.options.get("queryAll", "false")).lower() == "true")


def connector_scan(spark: SparkSession, path: str, name: str, version: str, columns: list[str] | None = None, query_all: bool = False,
                   schema: StructType | None = None) -> DataFrame:
    """Scan of an object's pages; comparisons on it reach the reader."""
    # Workers unpickle the reader without this package on their path.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagesSource)
    reader = (spark.read.format(NAME).option("path", path).option("object", name).option("version", version)
              .option("queryAll", str(query_all).lower()))
    if columns:
        reader = reader.option("columns", ",".join(columns))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def write_pages(df: DataFrame, path: str, name: str, version: str, order_by: str, page_rows: int) -> None:
    """Export an object in pages of ``page_rows`` rows at most, each a range of ``order_by``."""
    timed = df.select([F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])
    (timed.repartitionByRange(F.col(order_by)).sortWithinPartitions(order_by).write.mode("overwrite")
     .option("maxRecordsPerFile", str(int(page_rows))).parquet(f"{path.rstrip('/')}/{name}/v{version}"))
