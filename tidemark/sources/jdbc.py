"""JDBC scan of a pushed-down subquery (aggregate computed in the database)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_subquery_scan(spark: SparkSession, url: str, query: str, *, driver: str | None = None,
                       fetchsize: int = 10000, properties: dict | None = None) -> DataFrame:
    """Read the result of ``query`` over JDBC; the database evaluates it.

    Connection properties (user, password, ...) are passed explicitly.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("query", query)
              .option("fetchsize", str(int(fetchsize))))
    if driver:
        reader = reader.option("driver", driver)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def jdbc_watermark_query(log_table: str, table_name: str, ts_col: str, name_col: str,
                         lookback_seconds: int) -> str:
    """Subquery that lets the database find a table's watermark in its log.

    ``ts_col`` and ``name_col`` are the log's time and table-name columns.
    """
    name = table_name.replace("'", "''")
    top = f"MAX({ts_col}) - INTERVAL '{int(lookback_seconds)}' SECOND"
    return f"SELECT {top} AS watermark, MAX({ts_col}) AS top FROM {log_table} WHERE {name_col} = '{name}'"
