"""Publish partitions by switching their location in the catalog.

New rows of a partition are written beside the old ones, into a version folder
that no reader looks at.  When all files are there, one ``ALTER TABLE …
PARTITION … SET LOCATION`` each makes the catalog point to them.  Readers of
the table see a partition's old rows or its new ones, never a half-written
folder; a run that stops before the switch leaves all readers on the old rows,
and its files are found by :func:`unused_versions`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.upsert import assert_unique_keys, upsert_frames
from tidemark.sinks.catalog import _lit, _q
from tidemark.sinks.table import _values, one_null, partition_dir_name, partition_filter, write_partitioned

#: Name of the folder that holds the versions, hidden from path readers.
VERSIONS = "_versions"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # Hadoop FileSystem handle
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def locations(spark: SparkSession, table: str, partition_col: str) -> dict:
    """Location of each partition in the catalog, by its value (null partition: None)."""
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        value = row[0].split("=", 1)[1]
        shown = None if value in ("__HIVE_DEFAULT_PARTITION__", "null") else spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(value)
        spec = f"{_q(partition_col)} = {'null' if shown is None else _lit(shown)}"
        detail = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({spec})").where("col_name = 'Location'").first()
        out[shown] = detail[1]
    return out


def write_version(df: DataFrame, path: str, partition_col: str) -> str:
    """Write new partitions below a version folder of their own; returns it."""
    version = f"{path.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex[:12]}"
    write_partitioned(df, version, partition_col, dynamic=False)
    return version


def switch(spark: SparkSession, table: str, partition_col: str, version: str, values: list, emptied: list = ()) -> None:
    """Point the partitions ``values`` to ``version``; drop the ``emptied`` ones."""
    for v in values:
        spec = f"PARTITION ({_q(partition_col)} = {'null' if v is None else _lit(v)})"
        folder = f"{version}/{partition_dir_name(partition_col, v)}"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION {_lit(folder)}")
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {_lit(folder)}")
    for v in emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_q(partition_col)} = {'null' if v is None else _lit(v)})")
    spark.sql(f"REFRESH TABLE {table}")


def publish_overwrite(df: DataFrame, table: str, path: str, partition_col: str, before_switch=None) -> str:
    """Stage overwrite (the whole table) by switch: partitions without new rows leave the catalog."""
    spark = df.sparkSession
    df = one_null(df, partition_col)
    values = _values(df, partition_col)
    version = write_version(df, path, partition_col)
    if before_switch is not None:
        before_switch()
    old = locations(spark, table, partition_col)
    switch(spark, table, partition_col, version, values, [v for v in old if v not in values])
    return version


def publish_upsert(source: DataFrame, table: str, path: str, keys: list[str], partition_col: str, source_rows: int | None = None,
                   before_switch=None) -> str:
    """MERGE on keys and partition by switch; only the source's partitions get a new version."""
    spark = source.sparkSession
    source = one_null(source, partition_col)
    merge_keys = list(dict.fromkeys([*keys, partition_col]))
    assert_unique_keys(source, merge_keys)
    values = _values(source, partition_col)
    scope = spark.table(table).where(partition_filter(partition_col, values))
    merged = upsert_frames(scope, source, merge_keys, source_rows=source_rows)
    version = write_version(merged, path, partition_col)
    if before_switch is not None:
        before_switch()
    switch(spark, table, partition_col, version, values)
    return version


def unused_versions(spark: SparkSession, table: str, path: str, partition_col: str) -> list[str]:
    """Version folders that no partition points to (old ones, and those of stopped runs)."""
    fs, root = _path(spark, f"{path.rstrip('/')}/{VERSIONS}")
    if not fs.exists(root):
        return []
    used = "\n".join(locations(spark, table, partition_col).values())
    return sorted(s.getPath().toString() for s in fs.listStatus(root) if f"/{VERSIONS}/{s.getPath().getName()}/" not in used)
