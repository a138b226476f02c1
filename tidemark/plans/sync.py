"""The whole incremental sync as one function.

log --max - lookback--> watermark --> extract (incl. soft-deleted)
    empty? -> stop, nothing written
    scrub -> booleans -> yyyyMM -> text            (one pass each, lazy)
    stage (static overwrite, partitioned)          (lineage cut: read back)
    upsert stage into main (touched partitions)    (idempotent)
    optional publisher(stage)                      (e.g. JDBC, see sinks.jdbc)
    append watermark row, then control row         (written last: a failed run
                                                    is retried from the old mark)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.config import SyncConfig
from tidemark.functions.columns import col, to_timestamp_safe
from tidemark.operators.audit import control_row_values, log_row, watermark_row
from tidemark.operators.clean import (
    add_year_month,
    cast_all_string,
    detect_boolean_columns,
    encode_booleans,
    null_token_scrub,
)
from tidemark.operators.upsert import dedupe_latest, duplicate_keys
from tidemark.session import apply_session_defaults
from tidemark.sinks.catalog import create_table, sync_partitions
from tidemark.sinks.jdbc import jdbc_append_log
from tidemark.sinks.table import append_rows, one_null, stage_overwrite, upsert_table
from tidemark.sources.extract import incremental_extract
from tidemark.sources.jdbc import jdbc_subquery_scan, jdbc_watermark_query
from tidemark.sources.tables import read_partitioned, table_exists


@dataclass(frozen=True)
class LakePaths:
    """Folders of a sync; ``stage_table`` / ``main_table`` also name them in the catalog."""

    stage: str
    main: str
    watermark_log: str
    control_log: str
    settings: str
    stage_table: str | None = None
    main_table: str | None = None

    @classmethod
    def under(cls, root: str, stage_table: str | None = None, main_table: str | None = None) -> LakePaths:
        root = root.rstrip("/")
        return cls(f"{root}/stage", f"{root}/main", f"{root}/watermark_log", f"{root}/control_log",
                   f"{root}/settings", stage_table, main_table)


@dataclass
class SyncResult:
    status: str                         # "empty" or "merged"
    watermark: str | None               # lower bound used (exclusive), None = full extract
    extracted: int = 0
    inserted: int = 0
    updated: int = 0
    boolean_columns: list = field(default_factory=list)
    touched: list = field(default_factory=list)
    emptied: list = field(default_factory=list)


WATERMARK_LOG_SCHEMA = "table_name string, last_modified timestamp, run_time timestamp"
CONTROL_LOG_SCHEMA = ("table_name string, max_date_check timestamp, run_time timestamp, "
                      "merge_count bigint, source_success_rows bigint, inserted_rows bigint, "
                      "updated_rows bigint, batch_id string")
SETTINGS_SCHEMA = "table_name string, bool_column string"
_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_log(spark: SparkSession, path: str, schema: str = WATERMARK_LOG_SCHEMA) -> DataFrame | None:
    """A log table with its fixed schema, or None before the first append."""
    return spark.read.schema(schema).parquet(path) if table_exists(spark, path) else None


def log_marks(log: DataFrame | None, table_name: str, lookback_seconds: int) -> tuple[str | None, str | None]:
    """``(watermark, last logged value)`` as exact text, from one aggregate."""
    if log is None:
        return None, None
    top = F.max("last_modified")
    row = (log.where(F.col("table_name") == table_name)
              .agg(F.date_format(top - F.make_dt_interval(secs=F.lit(int(lookback_seconds))), _TEXT),
                   F.date_format(top, _TEXT)).first())
    return row[0], row[1]


class FileLogs:
    """Watermark and control log as parquet folders of the lake."""

    def __init__(self, spark: SparkSession, lake: LakePaths):
        self.spark, self.lake = spark, lake

    def marks(self, table_name: str, lookback_seconds: int) -> tuple[str | None, str | None]:
        return log_marks(read_log(self.spark, self.lake.watermark_log), table_name, lookback_seconds)

    def has_batch(self, table_name: str, batch_id: str) -> bool:
        log = read_log(self.spark, self.lake.control_log, CONTROL_LOG_SCHEMA)
        same = (F.col("table_name") == table_name) & (F.col("batch_id") == batch_id)
        return log is not None and not log.where(same).isEmpty()

    def append_watermark(self, row: DataFrame) -> None:
        append_rows(row, self.lake.watermark_log)

    def append_control(self, row: DataFrame) -> None:
        append_rows(row, self.lake.control_log)


class JdbcLogs:
    """The same logs in database tables.

    ``reader(query) -> DataFrame`` and ``writer(df, table)`` default to the JDBC
    scan of a subquery and the JDBC append.
    """

    def __init__(self, spark: SparkSession, url: str, watermark_table: str, control_table: str, *,
                 properties: dict | None = None, reader=None, writer=None):
        self.watermark_table, self.control_table = watermark_table, control_table
        self.read = reader or (lambda query: jdbc_subquery_scan(spark, url, query, properties=properties))
        self.write = writer or (lambda df, table: jdbc_append_log(df, url, table, properties=properties))

    def marks(self, table_name: str, lookback_seconds: int) -> tuple[str | None, str | None]:
        query = jdbc_watermark_query(self.watermark_table, table_name, "last_modified", "table_name", lookback_seconds)
        row = self.read(query).select(F.date_format("watermark", _TEXT), F.date_format("top", _TEXT)).first()
        return (None, None) if row is None else (row[0], row[1])

    def has_batch(self, table_name: str, batch_id: str) -> bool:
        name, batch = (x.replace("'", "''") for x in (table_name, batch_id))
        query = f"SELECT batch_id FROM {self.control_table} WHERE table_name = '{name}' AND batch_id = '{batch}'"
        return not self.read(query).isEmpty()

    def append_watermark(self, row: DataFrame) -> None:
        self.write(row, self.watermark_table)

    def append_control(self, row: DataFrame) -> None:
        self.write(row, self.control_table)


def stored_booleans(spark: SparkSession, lake: LakePaths, table_name: str) -> list[str] | None:
    """Boolean columns that the table's first run detected; None before it."""
    kept = read_log(spark, lake.settings, SETTINGS_SCHEMA)
    if kept is None:
        return None
    names = [r.bool_column for r in kept.where(F.col("table_name") == table_name).select("bool_column").distinct().collect()]
    return sorted(n for n in names if n is not None) if names else None


def store_booleans(spark: SparkSession, lake: LakePaths, table_name: str, columns: list[str]) -> None:
    """Keep the set; a row without a column says that it is empty."""
    append_rows(spark.createDataFrame([(table_name, c) for c in columns or [None]], SETTINGS_SCHEMA), lake.settings)


def sync(spark: SparkSession, source: DataFrame, cfg: SyncConfig, lake: LakePaths,
         publisher=None, logs=None) -> SyncResult:
    """One batch run: watermark from the log, extract, then :func:`load_batch`.

    ``logs`` is where watermark and control rows live (:class:`FileLogs` of the
    lake by default, or :class:`JdbcLogs`).  ``publisher(stage)`` runs after the
    upsert (see :func:`tidemark.sinks.jdbc.jdbc_publisher`).
    """
    apply_session_defaults(spark)  # text times depend on the session zone: UTC
    logs = logs or FileLogs(spark, lake)
    wm, last = logs.marks(cfg.table_name, cfg.lookback_seconds)
    extract = incremental_extract(source, cfg.modified_col, wm, cfg.columns,
                                  deleted=cfg.deleted_col, include_deleted=cfg.include_deleted)
    res = load_batch(spark, extract, cfg, lake, publisher=publisher, last_logged=last, from_log=True, logs=logs)
    res.watermark = wm
    return res


def _cleaned(extract: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Partition key from the date as written, scrub, then one row per merge key."""
    part = cfg.partition_col
    base = add_year_month(extract, cfg.created_col, part) if cfg.created_col else extract
    base = one_null(base, part)
    text_cols = [c for c in base.columns if c != part]
    out = (null_token_scrub(base, cfg.scrub_token, cfg.scrub_whole_value, text_cols)
           if cfg.scrub_token else base)
    # After the scrub, which can make keys equal, and on the keys of the merge.
    return dedupe_latest(out, cfg.merge_keys, cfg.dedupe_by) if cfg.dedupe_by is not None else out


def load_batch(spark: SparkSession, extract: DataFrame, cfg: SyncConfig, lake: LakePaths,
               publisher=None, last_logged: str | None = None, from_log: bool = False,
               logs=None, batch_id: str | None = None) -> SyncResult:
    """Clean -> stage -> upsert -> publish -> logs, for rows already extracted.

    Used by :func:`sync` and, per micro-batch, by the streaming runner.  With
    known boolean columns (from the config, or stored by the table's first run)
    the extract is read once, by the stage write, which also reports the
    largest modification time; rows, partitions and duplicate keys come from
    the stage's footers and key columns.  Only the first run of a table without
    given columns profiles the extract before it is staged.
    """
    apply_session_defaults(spark)
    logs = logs or FileLogs(spark, lake)
    if batch_id is not None and logs.has_batch(cfg.table_name, batch_id):
        return SyncResult(status="done before", watermark=None)
    if not from_log:
        last_logged = logs.marks(cfg.table_name, cfg.lookback_seconds)[1]
    part = cfg.partition_col
    if cfg.created_col is None and part not in extract.columns:
        raise ValueError(f"no created_col to derive {part!r} from, and the extract has no such column")
    missing = [k for k in cfg.key_cols if k not in extract.columns]
    if missing:
        raise ValueError(f"key columns not in the extract: {missing}")
    if extract.isEmpty():
        # Empty-input short cut: stage, main table and logs stay untouched.
        return SyncResult(status="empty", watermark=None)

    scrubbed = _cleaned(extract, cfg)
    if cfg.bool_columns is not None:
        bools = list(cfg.bool_columns)
    elif not cfg.detect_booleans:
        bools = []
    else:
        bools = stored_booleans(spark, lake, cfg.table_name)
        if bools is None:
            bools = detect_boolean_columns(scrubbed, [c for c in scrubbed.columns if c != part])
            store_booleans(spark, lake, cfg.table_name, bools)
    bools = [c for c in bools if c in scrubbed.columns]
    encoded = encode_booleans(scrubbed, bools, cfg.null_bool_as) if bools else scrubbed
    watched = Observation("tidemark_stage")
    modified = col(cfg.modified_col)
    if isinstance(encoded.schema[cfg.modified_col].dataType, StringType):
        modified = to_timestamp_safe(modified)
    staged = encoded.observe(watched, F.date_format(F.max(modified), _TEXT).alias("max_modified"))
    stage = stage_overwrite(cast_all_string(staged), lake.stage, part, table=lake.stage_table)
    max_modified = watched.get["max_modified"]
    if cfg.dedupe_by is None and not duplicate_keys(stage, cfg.merge_keys).isEmpty():
        raise ValueError(f"extract has duplicate keys on {cfg.merge_keys}; set dedupe_by to keep the latest")

    n_stage = stage.count()  # footers only
    res = upsert_table(stage, lake.main, list(cfg.key_cols), part, key_only=not cfg.merge_on_partition,
                       source_rows=n_stage, count_changes=True, observe_max_of=cfg.modified_col,
                       newest_by=cfg.modified_col if cfg.newest_wins else None, keys_checked=True)
    if lake.main_table is not None:
        if not spark.catalog.tableExists(lake.main_table):
            main = read_partitioned(spark, lake.main, part)
            create_table(spark, lake.main_table, main.schema, part, lake.main)
            spark.sql(f"ALTER TABLE {lake.main_table} RECOVER PARTITIONS")
        else:
            sync_partitions(spark, lake.main_table, part,
                            added=[v for v in res.touched if v not in res.emptied], dropped=res.emptied)

    if publisher is not None:
        publisher(stage)

    # New mark: max over the rewritten partitions (seen during the write) and
    # the last logged value; untouched partitions cannot hold a later time.
    # Without a logged value the whole main table is read once.
    if last_logged is None and not res.created:
        main = read_partitioned(spark, lake.main, part)
        logs.append_watermark(watermark_row(main, cfg.table_name, cfg.modified_col, cfg.zone))
    else:
        marks = [m for m in (res.max_modified, last_logged) if m is not None]
        logs.append_watermark(log_row(spark, cfg.table_name, max(marks) if marks else None, cfg.zone))
    logs.append_control(control_row_values(spark, cfg.table_name, max_modified, cfg.zone, rows=n_stage,
                                           inserted=res.inserted, updated=res.updated, batch_id=batch_id))
    return SyncResult(status="merged", watermark=None, extracted=n_stage, inserted=res.inserted,
                      updated=res.updated, boolean_columns=bools, touched=res.touched, emptied=res.emptied)
