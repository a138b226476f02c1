"""Global row numbering and batch slicing without a single-task window.

``ROW_NUMBER() OVER (ORDER BY key DESC)`` with no PARTITION BY makes Spark
move every row into one task.  The scalable form:

1. range-partition on ``(key DESC, row hash)`` and sort inside each
   partition; the row hash splits a hot key over several partitions and makes
   the order total, so ties get the same numbers on every run;
2. write that layout once with a reliable ``checkpoint()`` (shared
   checkpoint folder), so the counts and the numbers read the very same rows
   and a lost executor recomputes nothing upstream;
3. count rows per partition (one number per partition reaches the driver),
   turn the counts into start offsets, and number each row as
   ``offset[partition] + position in partition + 1``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col

_POSITION_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the position in the low 33 bits


def _order(keys: list[str], descending: bool) -> list[Column]:
    return [col(k).desc_nulls_last() if descending else col(k).asc_nulls_first() for k in keys]


def row_number_global(df: DataFrame, keys: list[str], out: str = "rowNum",
                      descending: bool = True) -> DataFrame:
    """Plain form (one task): kept for comparison and tiny inputs only."""
    w = Window.orderBy(*_order(keys, descending))
    return df.withColumn(out, F.row_number().over(w))


def row_number_ranged(df: DataFrame, keys: list[str], out: str = "rowNum",
                      descending: bool = True, num_partitions: int | None = None,
                      rows: int | None = None) -> DataFrame:
    """Scalable global row number, ``1..N`` in ``keys`` order (see module doc).

    The number of ranges is ``num_partitions``, else sized from the row count
    (``rows``, counted when not given: about two million rows per range).  Returns a frame whose lineage starts at the checkpoint; ``out``
    is a long.
    """
    spark = df.sparkSession
    if num_partitions is None:
        rows = df.count() if rows is None else rows
        num_partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(rows))
    cols = df.columns
    tiebreak = F.xxhash64(*[col(c) for c in cols]).alias("__tb")
    order = _order(keys, descending) + [F.col("__tb").asc()]
    laid_out = (df.select(*[col(c) for c in cols], tiebreak)
                  .repartitionByRange(num_partitions, *order)
                  .sortWithinPartitions(*order))
    fixed = laid_out.checkpoint(eager=True)
    tagged = fixed.select(*[col(c) for c in cols],
                          F.spark_partition_id().alias("__pid"),
                          F.monotonically_increasing_id().alias("__mid"))
    # One count per partition reaches the driver; the offsets go back as a
    # broadcast table with one row per partition (a size fixed by the layout).
    counts = sorted(tuple(r) for r in tagged.groupBy("__pid").agg(F.count(F.lit(1))).collect())
    offsets, running = [], 0
    for pid, n in counts:
        offsets.append((pid, running))
        running += n
    starts = spark.createDataFrame(offsets or [(0, 0)], "__pid int, __start bigint")
    position = F.col("__mid").bitwiseAND(F.lit(_POSITION_MASK))
    return (tagged.join(F.broadcast(starts), "__pid")
                  .select(*[col(c) for c in cols], (F.col("__start") + position + 1).alias(out)))


def slice_ids(df: DataFrame, size: int, row_col: str = "rowNum", out: str = "batch_id") -> DataFrame:
    """Slice ``(i*size, (i+1)*size]`` of the numbering -> ``batch_id = i``."""
    if size <= 0:
        raise ValueError("slice size must be positive")
    return df.withColumn(out, F.floor((col(row_col) - 1) / F.lit(size)).cast("bigint"))


def slice_rows(df: DataFrame, lo: int, hi: int, row_col: str = "rowNum") -> DataFrame:
    """Rows with ``lo < rowNum <= hi`` (one slice of the publish loop)."""
    return df.where((col(row_col) > F.lit(lo)) & (col(row_col) <= F.lit(hi)))


def batch_summary(numbered: DataFrame, size: int, row_col: str = "rowNum") -> DataFrame:
    """Per slice: rows, first and last row number (one small aggregate)."""
    return (slice_ids(numbered, size, row_col)
            .groupBy("batch_id")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min(col(row_col)).alias("first_row"),
                 F.max(col(row_col)).alias("last_row")))


def partitions_for(rows: int, rows_per_partition: int = 2_000_000) -> int:
    """A partition count that keeps each numbering task near a target size."""
    return max(1, math.ceil(rows / rows_per_partition))
