"""Partitioned external tables in the session catalog.

A catalog table over a path tracks its partitions; files written by path
become visible after their partitions are added.  The upsert knows exactly
which partitions it rewrote or emptied, so only those are added or dropped
(no full ``RECOVER PARTITIONS`` listing of the table on every run).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table_sql(name: str, schema: StructType, partition_col: str, path: str,
                     fmt: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS … USING parquet PARTITIONED BY (…) LOCATION …``.

    The partition column goes last, as Spark stores it.
    """
    fields = [f for f in schema.fields if f.name != partition_col]
    fields += [f for f in schema.fields if f.name == partition_col]
    cols = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in fields)
    return (f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt} "
            f"PARTITIONED BY ({_q(partition_col)}) LOCATION {_lit(path)}")


def create_table(spark: SparkSession, name: str, schema: StructType, partition_col: str, path: str,
                 fmt: str = "parquet") -> None:
    spark.sql(create_table_sql(name, schema, partition_col, path, fmt))


def sync_partitions(spark: SparkSession, name: str, partition_col: str,
                    added=(), dropped=()) -> None:
    """Add / drop the given partitions in the catalog, then refresh cached listings.

    A NULL partition value (the default partition folder) cannot be named in
    a partition spec; it is picked up by ``ALTER TABLE … RECOVER PARTITIONS``.
    """
    adds = [v for v in added if v is not None]
    if adds:
        specs = " ".join(f"PARTITION ({_q(partition_col)} = {_lit(v)})" for v in adds)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    drops = [v for v in dropped if v is not None]
    if drops:
        specs = ", ".join(f"PARTITION ({_q(partition_col)} = {_lit(v)})" for v in drops)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
    if any(v is None for v in list(added) + list(dropped)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
