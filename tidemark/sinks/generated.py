"""Generated merge statements that Spark itself can run.

Parquet tables take no MERGE.  The same change is an overwrite of the touched
partitions with the source's rows and the target's rows whose key is not in
the source; :func:`merge_overwrite_sql` writes that statement from a column
list and two table names, and :func:`run_generated` keeps it in a session
variable and runs it with ``EXECUTE IMMEDIATE``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _name(n: str) -> str:
    return "`" + n.replace("`", "``") + "`"


def merge_overwrite_sql(target: str, source: str, columns: list[str], keys: list[str], partition_col: str) -> str:
    """INSERT OVERWRITE of the source's partitions: source rows, and target rows without a source key.

    Keys and the partition compare null-safe, as the frame form does.
    """
    absent = [c for c in [*keys, partition_col] if c not in columns]
    if absent:
        raise ValueError(f"not among the columns: {absent}")
    order = [c for c in columns if c != partition_col] + [partition_col]
    listed = ", ".join(_name(c) for c in order)
    part = _name(partition_col)
    match = " AND ".join(f"tgt.{_name(k)} <=> src.{_name(k)}" for k in dict.fromkeys([*keys, partition_col]))
    return (f"INSERT OVERWRITE TABLE {target} PARTITION ({part}) "
            f"SELECT {listed} FROM {source} "
            f"UNION ALL SELECT {', '.join('tgt.' + _name(c) for c in order)} FROM {target} tgt "
            f"LEFT SEMI JOIN (SELECT DISTINCT {part} FROM {source}) parts ON tgt.{part} <=> parts.{part} "
            f"LEFT ANTI JOIN (SELECT {', '.join(_name(k) for k in dict.fromkeys([*keys, partition_col]))} FROM {source}) src ON {match}")


def run_generated(spark: SparkSession, statement: str, variable: str = "tidemark_statement") -> None:
    """Run a statement out of a session variable, replacing only the partitions it writes."""
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.sql(f"DECLARE OR REPLACE VARIABLE {variable} STRING")
        spark.sql(f"SET VAR {variable} = :text", args={"text": statement})
        spark.sql(f"EXECUTE IMMEDIATE {variable}")
    finally:
        spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {variable}")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
