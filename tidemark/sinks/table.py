"""Partitioned parquet tables: stage overwrite, compaction and upsert.

Open-source parquet tables have no MERGE and no OPTIMIZE; both are built
from reads and dynamic partition overwrites that touch only the partitions a
run changes.  Writes go through a REBALANCE on the partition column: AQE
packs small partitions together and splits a hot partition over several
tasks, so files come out near the advisory size without a later
compaction.  Readers see no snapshot isolation while a multi-partition
overwrite commits (parquet has no transaction log).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.columns import col, to_timestamp_safe
from tidemark.sinks.catalog import sync_partitions
from tidemark.sinks.key_index import KeyIndex
from tidemark.operators.upsert import (
    DEFAULT_BROADCAST_LIMIT,
    assert_unique_keys,
    fits_broadcast,
    matched_target_rows,
    upsert_frames,
    with_missing_columns,
    without_older,
)
from tidemark.sources.tables import read_partitioned, read_table, table_exists

DEFAULT_PARTITION_DIR = "__HIVE_DEFAULT_PARTITION__"
# A source with at most this share of the rewritten rows is clustered alone (layout
# only: tests hold both layouts to the same rows).
NARROW_SHARE = 0.25
# Characters that Hive-style partition folder names escape as %XX.
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^')


def partition_dir_name(column: str, value) -> str:
    if value is None or value == "":
        return f"{column}={DEFAULT_PARTITION_DIR}"
    text = str(value)
    esc = "".join(f"%{ord(ch):02X}" if (ord(ch) < 0x20 or ch in _ESCAPED) else ch for ch in text)
    return f"{column}={esc}"


def partition_filter(partition_col: str, values) -> Column:
    """``part IN (values)``; NULL and ``""`` are one value, stored as NULL."""
    vals = [v for v in values if v is not None and v != ""]
    cond = col(partition_col).isin(vals) if vals else F.lit(False)
    if len(vals) < len(list(values)):
        cond = cond | col(partition_col).isNull()
    return cond


def one_null(df: DataFrame, partition_col: str) -> DataFrame:
    """``""`` in the partition column becomes NULL: both share one folder."""
    if not isinstance(df.schema[partition_col].dataType, StringType):
        return df
    return df.withColumn(partition_col, F.nullif(col(partition_col), F.lit("")))


def write_partitioned(df: DataFrame, path: str, partition_col: str, *, dynamic: bool = True,
                      rebalance: bool = True, max_records_per_file: int | None = None,
                      table: str | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` partitioned by ``partition_col``.

    ``dynamic=True`` replaces only the partitions present in ``df``;
    ``dynamic=False`` replaces the whole table.
    """
    df = one_null(df, partition_col)
    out = df.hint("rebalance", partition_col) if rebalance else df
    w = (out.write.mode(mode).format("parquet").partitionBy(partition_col)
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(int(max_records_per_file)))
    if table is not None:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)


def stage_overwrite(df: DataFrame, path: str, partition_col: str, *, table: str | None = None,
                    max_records_per_file: int | None = None) -> DataFrame:
    """Replace the whole stage table with ``df``; returns the stage read back."""
    write_partitioned(df, path, partition_col, dynamic=False, table=table,
                      max_records_per_file=max_records_per_file)
    return read_table(df.sparkSession, path, df.schema)


def compact_table(spark: SparkSession, path: str, partition_col: str, schema=None,
                  partitions: list | None = None, max_records_per_file: int | None = None,
                  max_small_files: int = 8, small_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Rewrite small files (dynamic overwrite) of ``partitions``.

    Without a list, only the partitions that hold more than
    ``max_small_files`` files below ``small_bytes``; sound ones stay untouched.
    """
    df = read_table(spark, path, schema)
    if partitions is None:
        partitions = crowded_partitions(spark, path, partition_col, _values(df, partition_col),
                                        max_small_files, small_bytes)
    if partitions:
        write_partitioned(df.where(partition_filter(partition_col, partitions)), path, partition_col,
                          dynamic=True, max_records_per_file=max_records_per_file)
    return read_table(spark, path, schema)


def append_rows(df: DataFrame, path: str) -> None:
    """Append a few rows (log tables) as one file."""
    df.coalesce(1).write.mode("append").format("parquet").save(path)


def delete_partition_dirs(spark: SparkSession, path: str, partition_col: str, values) -> None:
    """Remove partition folders that an overwrite left behind (Hadoop FS API)."""
    jvm = spark.sparkContext._jvm  # only handle to the Hadoop FileSystem from Python
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_dir_name(partition_col, v)}")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)


def crowded_partitions(spark: SparkSession, path: str, partition_col: str, values,
                       max_small_files: int = 8, small_bytes: int = 64 * 1024 * 1024) -> list:
    """Partitions among ``values`` holding more than ``max_small_files`` small data files.

    Lists only the named partition folders (file system metadata, no job).
    """
    jvm = spark.sparkContext._jvm  # only handle to the Hadoop FileSystem from Python
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    crowded = []
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_dir_name(partition_col, v)}")
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            continue
        small = sum(1 for st in fs.listStatus(p)
                    if st.isFile() and not st.getPath().getName().startswith(("_", "."))
                    and st.getLen() < small_bytes)
        if small > max_small_files:
            crowded.append(v)
    return crowded


@dataclass
class UpsertResult:
    touched: list = field(default_factory=list)   # partitions rewritten
    emptied: list = field(default_factory=list)   # partitions removed (all rows moved away)
    created: bool = False                         # the table did not exist before
    updated: int | None = None                    # target rows replaced (count_changes)
    inserted: int | None = None                   # source rows with a new key (count_changes)
    max_modified: str | None = None               # max of ``observe_max_of`` over the rewritten rows
    compacted: list = field(default_factory=list)  # partitions compacted after the write
    probed: list | None = None                    # partitions whose key column was read (with a key index)
    probe_rows: int | None = None                 # rows in them


def _values(df: DataFrame, name: str) -> list:
    return [r[0] for r in df.select(col(name)).distinct().collect()]


def _observed_max(df: DataFrame, name: str | None) -> tuple[DataFrame, Observation | None]:
    """Watch ``max(name)`` while the write runs (no extra scan).

    Only an idempotent aggregate is observed: a task retried after a lost
    executor reports the same maximum again.
    """
    if name is None:
        return df, None
    c = col(name)
    if isinstance(df.schema[name].dataType, StringType):
        c = to_timestamp_safe(c)
    obs = Observation("tidemark_upsert_max")
    return df.observe(obs, F.date_format(F.max(c), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m")), obs


def _may_hold(target: DataFrame, source: DataFrame, index: KeyIndex, path: str,
              partition_col: str) -> tuple[list, int, DataFrame]:
    """Partitions that may hold a source key, their rows, and the target in them."""
    names = {partition_dir_name(partition_col, v): v for v in _values(target, partition_col)}
    probed = [names[r[0]] for r in index.candidates(source).collect() if r[0] in names]
    scope = target.where(partition_filter(partition_col, probed))
    return probed, scope.count(), scope


def upsert_table(source: DataFrame, path: str, keys: list[str], partition_col: str, *,
                 key_only: bool = False, source_rows: int | None = None,
                 source_partitions: list | None = None, count_changes: bool = False,
                 observe_max_of: str | None = None, newest_by: str | None = None,
                 keys_checked: bool = False, layout: str = "auto",
                 broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                 max_records_per_file: int | None = None,
                 table: str | None = None, compact_over: int | None = 8,
                 index_path: str | None = None) -> UpsertResult:
    """MERGE ``source`` into the partitioned table at ``path``.

    ``key_only=False``: match on ``keys`` + the partition column (composite
    key), so only the source's partitions are read and rewritten.

    ``key_only=True``: match on ``keys`` alone; a row whose partition value
    changed moves.  The partitions that held the old versions are rewritten
    too, and the ones left without rows are removed, so no stale copy stays.

    The target is read with its own schema.  A source that lacks some of its
    columns updates only the columns it has (new rows have NULL in the others);
    a source with columns that the table lacks is an error.  Duplicate source
    keys are an error (``keys_checked`` says the caller has looked).  With
    ``newest_by``, a source row older than the target's row loses.

    The partition lists are the only values that reach the driver (one per
    partition, never per row).  ``count_changes`` adds exact updated /
    inserted counts from two footer-only row counts of the rewritten
    partitions (before and after), not from a join.  ``table`` names a
    catalog table over ``path`` whose partition list is kept in step.

    ``layout`` is ``narrow`` (kept rows are written as scanned, the source's
    rows are clustered), ``rebalance`` (the merged set is clustered) or
    ``auto``; it decides file layout only, never rows.  Partitions with more
    than ``compact_over`` small files are compacted after the write.

    ``index_path`` keeps a :class:`KeyIndex` over ``keys`` beside the table.  A
    ``key_only`` upsert then reads the key column only in the partitions that
    may hold a source key; without an index there, the first upsert builds it.
    """
    spark = source.sparkSession
    index = KeyIndex(index_path, path, list(keys), partition_col) if index_path is not None else None
    source = one_null(source, partition_col)
    merge_keys = list(keys) if key_only else list(dict.fromkeys([*keys, partition_col]))
    if not keys_checked:
        assert_unique_keys(source, merge_keys)
    exists = table_exists(spark, path)
    target = None
    given = source  # the same keys and partitions, before it is joined to the target
    if exists:
        target = read_partitioned(spark, path, partition_col,
                                  source.schema[partition_col].dataType.simpleString())
        have = {c.lower() for c in target.columns}
        extra = [c for c in source.columns if c.lower() not in have]
        if extra:
            raise ValueError(f"the table at {path} has no columns {extra}")
        if newest_by is not None:
            source = without_older(target, source, merge_keys, newest_by, source_rows=source_rows,
                                   broadcast_limit=broadcast_limit)
            source_rows = source_partitions = None  # what is left decides
        given = source
        source = with_missing_columns(target, source, merge_keys, source_rows=source_rows,
                                      broadcast_limit=broadcast_limit)
    if source_partitions is None:
        source_partitions = _values(given, partition_col)
    source_partitions = list(dict.fromkeys(None if v == "" else v for v in source_partitions))
    if source_rows is None and (count_changes or newest_by is not None):
        source_rows = source.count()
    if not exists:
        watched, obs = _observed_max(source, observe_max_of)
        write_partitioned(watched, path, partition_col, dynamic=True,
                          max_records_per_file=max_records_per_file)
        if table is not None:
            sync_partitions(spark, table, partition_col, added=source_partitions)
        if index is not None:
            index.refresh(read_table(spark, path, source.schema))
        return UpsertResult(touched=list(source_partitions), created=True,
                            updated=0 if count_changes else None,
                            inserted=source_rows if count_changes else None,
                            max_modified=obs.get["m"] if obs else None)

    touched, emptied = list(source_partitions), []
    probed = probe_rows = None
    if key_only:
        # One probe of the key column: matches per partition.  A partition that
        # gets no source rows and whose rows all match is left empty.
        probe = target
        if index is not None and index.exists(spark) and index.same_types(source, target):
            probed, probe_rows, probe = _may_hold(target, given, index, path, partition_col)
        probe = probe.select(*[col(k) for k in dict.fromkeys([*keys, partition_col])])
        matched = {r[0]: r[1] for r in matched_target_rows(
            probe, given, keys, source_rows=source_rows, broadcast_limit=broadcast_limit)
            .groupBy(col(partition_col)).agg(F.count(F.lit(1))).collect()}
        only_old = [v for v in matched if v not in touched]
        if only_old:
            held = {r[0]: r[1] for r in target.where(partition_filter(partition_col, only_old))
                    .groupBy(col(partition_col)).agg(F.count(F.lit(1))).collect()}
            emptied = [v for v in only_old if held.get(v) == matched[v]]
        touched += only_old
    scope = target.where(partition_filter(partition_col, touched))
    # Footer-only count of the rewritten partitions.
    before = scope.count() if (count_changes or source_rows is not None) else None
    # With broadcast source keys the target side is not shuffled: its rows
    # leave the scan grouped by file, hence by partition, and can be written
    # as they come next to a small clustered source.
    broadcast = fits_broadcast(given.select(*[col(k) for k in merge_keys]), source_rows, broadcast_limit)
    narrow = layout == "narrow" or (layout == "auto" and broadcast and before is not None
                                    and source_rows <= NARROW_SHARE * before)
    merged = upsert_frames(scope, source, merge_keys, source_rows=source_rows,
                           broadcast_limit=broadcast_limit, source_keys=given,
                           source_layout=(lambda df: df.hint("rebalance", partition_col)) if narrow else None)
    watched, obs = _observed_max(merged, observe_max_of)
    write_partitioned(watched, path, partition_col, dynamic=True, rebalance=not narrow,
                      max_records_per_file=max_records_per_file)
    if emptied:
        delete_partition_dirs(spark, path, partition_col, emptied)
    compacted: list = []
    if compact_over is not None:
        compacted = crowded_partitions(spark, path, partition_col,
                                       [v for v in touched if v not in emptied], compact_over)
        if compacted:
            compact_table(spark, path, partition_col, target.schema, partitions=compacted,
                          max_records_per_file=max_records_per_file)
    if table is not None:
        sync_partitions(spark, table, partition_col,
                        added=[v for v in touched if v not in emptied], dropped=emptied)
    if index is not None:
        stored = read_table(spark, path, target.schema)
        index.refresh(stored, [partition_dir_name(partition_col, v) for v in touched] if index.exists(spark) else None)
    res = UpsertResult(touched=touched, emptied=emptied, max_modified=obs.get["m"] if obs else None,
                       compacted=compacted, probed=probed, probe_rows=probe_rows)
    if count_changes:
        after = read_table(spark, path, target.schema).where(partition_filter(partition_col, touched)).count()
        kept = after - source_rows
        res.updated = before - kept
        res.inserted = source_rows - res.updated
    return res
