"""Watermark protocol: last loaded point of a table, minus a look-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, watermark_text


def _lookback(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(int(seconds)))


def watermark_lookup(log: DataFrame, table_name: str, ts_col: str = "last_modified",
                     name_col: str = "table_name", lookback_seconds: int = 600,
                     alias: str = "watermark") -> DataFrame:
    """One-row frame: ``max(ts) - lookback`` over the log rows of one table.

    NULL when the table has no log row yet (first run: full extract).
    """
    return (log.where(col(name_col) == F.lit(table_name))
               .agg((F.max(col(ts_col)) - _lookback(lookback_seconds)).alias(alias)))


def watermark_literal(wm: DataFrame, alias: str = "watermark_text") -> DataFrame:
    """The watermark as ``yyyy-MM-ddTHH:mm:ssZ`` text (session zone = UTC)."""
    c = wm.columns[0]
    return wm.select(watermark_text(col(c)).alias(alias))


def read_watermark(log: DataFrame | None, table_name: str, ts_col: str = "last_modified",
                   name_col: str = "table_name", lookback_seconds: int = 600) -> str | None:
    """The watermark as exact text (microseconds), or None on a first run.

    One value crosses to the driver; as text it turns back into a typed
    literal that the scan can push down, whatever the column's zone type.
    """
    if log is None:
        return None
    wm = watermark_lookup(log, table_name, ts_col, name_col, lookback_seconds)
    row = wm.select(F.date_format(F.col("watermark"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()
    return None if row is None else row[0]
