"""Audit rows appended after a run: the watermark row and the control row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.columns import col, to_timestamp_safe


def _as_time(df: DataFrame, name: str) -> Column:
    # Text is cast before the max: text order is not time order once offsets differ.
    c = col(name)
    return to_timestamp_safe(c) if isinstance(df.schema[name].dataType, StringType) else c


def run_time(zone: str, at: str | None = None) -> Column:
    """Time of the run as a wall clock in ``zone``: now, or a given UTC time."""
    now = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return F.from_utc_timestamp(now, zone)


def watermark_row(main: DataFrame, table_name: str, modified_col: str, zone: str = "UTC",
                  previous: Column | None = None, at: str | None = None) -> DataFrame:
    """``(table_name, last_modified, run_time)``: max modification time of the main table.

    ``previous`` (the last logged value) lets a caller pass only the rewritten
    partitions as ``main``: the untouched ones cannot hold a later time.
    """
    top = F.max(_as_time(main, modified_col))
    if previous is not None:
        top = F.greatest(top, previous)
    return main.agg(F.lit(table_name).alias("table_name"), top.alias("last_modified"),
                    run_time(zone, at).alias("run_time"))


def control_row(stage: DataFrame, table_name: str, modified_col: str, zone: str = "UTC",
                inserted: int | None = None, updated: int | None = None,
                at: str | None = None) -> DataFrame:
    """``(table_name, max_date_check, run_time, merge_count, source_success_rows,
    inserted_rows, updated_rows)`` over the stage.

    ``merge_count`` and ``source_success_rows`` both count the stage, as the
    reference logs them; the true split comes from the upsert's counts.
    """
    n = F.count(F.lit(1))
    cols = [F.lit(table_name).alias("table_name"),
            F.max(_as_time(stage, modified_col)).alias("max_date_check"),
            run_time(zone, at).alias("run_time")]
    cols += [n.alias("merge_count"), n.alias("source_success_rows"),
             F.lit(inserted).cast("bigint").alias("inserted_rows"),
             F.lit(updated).cast("bigint").alias("updated_rows")]
    return stage.agg(*cols)


def log_row(spark, table_name: str, last_modified: str | None, zone: str = "UTC") -> DataFrame:
    """Watermark row from a known value (text ``yyyy-MM-dd HH:mm:ss[.SSSSSS]``)."""
    return spark.range(1).select(F.lit(table_name).alias("table_name"),
                                 F.lit(last_modified).cast("timestamp").alias("last_modified"),
                                 run_time(zone).alias("run_time"))


def control_row_values(spark, table_name: str, max_date: str | None, zone: str = "UTC", *,
                       rows: int, inserted: int | None, updated: int | None,
                       batch_id: str | None = None) -> DataFrame:
    """Control row from values already known to the run (no rescan of the stage)."""
    return spark.range(1).select(F.lit(table_name).alias("table_name"),
                                 F.lit(max_date).cast("timestamp").alias("max_date_check"),
                                 run_time(zone).alias("run_time"),
                                 F.lit(rows).cast("bigint").alias("merge_count"),
                                 F.lit(rows).cast("bigint").alias("source_success_rows"),
                                 F.lit(inserted).cast("bigint").alias("inserted_rows"),
                                 F.lit(updated).cast("bigint").alias("updated_rows"),
                                 F.lit(batch_id).cast("string").alias("batch_id"))
