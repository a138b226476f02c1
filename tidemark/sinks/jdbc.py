"""Publish to a relational database over JDBC, as the reference does.

Rows are renamed for the database's identifier limit, a few text columns
are re-typed to timestamps, written to a stage table, and merged into the
target with one MERGE statement run in the database.  ``bounded=True``
keeps the reference's bounded transactions: slices of ``slice_size`` rows
by a global row number (key descending), one stage write + MERGE each.
``bounded=False`` writes everything in one partitioned JDBC write and runs
one MERGE, which is the form to use for large volumes.

Spark has no public API for running a statement in a database, so the MERGE
goes through ``java.sql.DriverManager`` on the driver (one statement per
slice; no rows pass through the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import SyncConfig
from tidemark.functions.columns import col
from tidemark.operators.clean import rename_for_sink, retype_timestamps
from tidemark.operators.number import row_number_ranged, slice_rows
from tidemark.session import drop_scratch, scratch_path
from tidemark.sources.tables import read_table


def merge_sql(target: str, stage: str, columns: list[str], keys: list[str],
              quote: str = "", update_columns: list[str] | None = None) -> str:
    """MERGE of ``stage`` into ``target``.

    Matched rows get ``update_columns`` (all but the keys when not given), new
    rows get ``columns``.
    """
    absent = [c for c in [*keys, *(update_columns or [])] if c not in columns]
    if absent:
        raise ValueError(f"not among the columns: {absent}")
    changed = [c for c in columns if c not in keys] if update_columns is None else update_columns
    names = {c: f"{quote}{c}{quote}" for c in columns}

    def pairs(chosen: list[str], between: str) -> str:
        return between.join(f"tgt.{names[c]} = src.{names[c]}" for c in chosen)

    lines = [f"MERGE INTO {target} tgt", f"USING {stage} src", f"ON ({pairs(keys, ' AND ')})"]
    if changed:
        lines.append(f"WHEN MATCHED THEN UPDATE SET {pairs(changed, ', ')}")
    lines.append(f"WHEN NOT MATCHED THEN INSERT ({', '.join(names.values())}) "
                 f"VALUES ({', '.join('src.' + n for n in names.values())})")
    return " ".join(lines)


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", *,
               properties: dict | None = None, batchsize: int = 10000,
               num_partitions: int | None = None, truncate: bool = True) -> None:
    """Plain JDBC write; ``overwrite`` keeps the table and truncates it."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
           .option("batchsize", str(int(batchsize))))
    if mode == "overwrite" and truncate:
        w = w.option("truncate", "true")
    if num_partitions is not None:
        w = w.option("numPartitions", str(int(num_partitions)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def jdbc_append_log(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Append audit rows (watermark row, control row) to a log table."""
    jdbc_write(df.coalesce(1), url, table, "append", properties=properties)


def execute_statement(spark: SparkSession, url: str, sql: str, properties: dict | None = None) -> int:
    """Run one statement in the database; returns the update count."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        stmt = conn.createStatement()
        try:
            return stmt.executeUpdate(sql)
        finally:
            stmt.close()
    finally:
        conn.close()


def prepare_for_sink(df: DataFrame, rename_map: dict | None = None, timestamp_cols=(),
                     identifier_limit: int | None = 30) -> DataFrame:
    """Re-type the chosen text columns to timestamps, then rename for the sink."""
    out = retype_timestamps(df, list(timestamp_cols)) if timestamp_cols else df
    return rename_for_sink(out, rename_map or {}, identifier_limit)


def jdbc_publish(spark: SparkSession, df: DataFrame, url: str, stage_table: str, target_table: str,
                 keys: list[str], *, properties: dict | None = None, slice_size: int = 10000,
                 bounded: bool = False, rename_map: dict | None = None, timestamp_cols=(),
                 identifier_limit: int | None = 30, quote: str = "",
                 update_columns: list[str] | None = None,
                 writer=None, executor=None) -> list[tuple[int, int]]:
    """Publish ``df`` into ``target_table``; returns ``[(batch_id, rows), ...]``.

    ``keys`` are named as in the sink (after renames).  ``writer`` /
    ``executor`` default to :func:`jdbc_write` / :func:`execute_statement`.

    ``bounded=True`` runs one transaction per ``slice_size`` rows: the numbered
    rows are written once, in number order, and each slice is a range of row
    numbers that the scan finds by the files' statistics.
    """
    writer = writer or jdbc_write
    executor = executor or execute_statement
    out = prepare_for_sink(df, rename_map, timestamp_cols, identifier_limit)
    columns = out.columns
    stmt = merge_sql(target_table, stage_table, columns, keys, quote, update_columns)
    if not bounded:
        writer(out, url, stage_table, "overwrite", properties=properties, batchsize=slice_size)
        executor(spark, url, stmt, properties)
        return [(0, -1)]

    rows = out.count()
    path = scratch_path(spark, "publish")
    numbered = row_number_ranged(out, keys, "row_number", descending=True, rows=rows)
    numbered.write.parquet(path)
    stored = read_table(spark, path, numbered.schema)
    sizes = []
    for lo in range(0, rows, slice_size):
        part = slice_rows(stored, lo, lo + slice_size, "row_number").select([col(c) for c in columns])
        writer(part, url, stage_table, "overwrite", properties=properties, batchsize=slice_size)
        executor(spark, url, stmt, properties)
        sizes.append((lo // slice_size, min(slice_size, rows - lo)))
    drop_scratch(spark, path)
    return sizes


def jdbc_publisher(cfg: SyncConfig, url: str, stage_table: str, target_table: str, *,
                   properties: dict | None = None, bounded: bool = False, quote: str = "",
                   writer=None, executor=None):
    """``publisher`` for :func:`tidemark.plans.sync.sync` from the config's publish fields."""
    keys = [cfg.rename_map.get(k, k) for k in cfg.key_cols]

    def publish(stage: DataFrame) -> list[tuple[int, int]]:
        return jdbc_publish(stage.sparkSession, stage, url, stage_table, target_table, keys,
                            properties=properties, slice_size=cfg.slice_size, bounded=bounded,
                            rename_map=cfg.rename_map, timestamp_cols=cfg.timestamp_cols,
                            identifier_limit=cfg.identifier_limit, quote=quote,
                            writer=writer, executor=executor)
    return publish
