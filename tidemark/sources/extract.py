"""Incremental extract: rows changed after the watermark, soft-deletes kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from tidemark.functions.columns import col, to_timestamp_safe


def incremental_extract(src: DataFrame, modified_col: str, watermark: str | Column | None,
                        columns: list[str] | tuple[str, ...] | None = None,
                        deleted: str | Column | None = None,
                        include_deleted: bool = True,
                        deleted_alias: str | None = None) -> DataFrame:
    """Rows with ``modified_col`` strictly greater than ``watermark``.

    ``watermark`` is text from :func:`read_watermark` (cast to the column's own
    type, so Catalyst folds it into a literal that reaches the parquet scan as
    a pushed filter), a Column, or None for a full extract.  A text column is
    compared as timestamps; text that is none is not extracted.

    ``deleted`` names the soft-delete flag (a column name or a boolean Column).
    With ``include_deleted`` the flagged rows are kept and, when
    ``deleted_alias`` is given, the flag is carried as ``"true"``/``"false"``
    text; otherwise they are filtered out.
    """
    df = src
    if columns is not None:
        df = df.select([col(c) for c in columns])
    if watermark is not None:
        dtype = src.schema[modified_col].dataType
        if isinstance(dtype, StringType):
            # Text with mixed offsets has no time order: both sides become instants.
            bound = watermark if isinstance(watermark, Column) else F.lit(watermark).cast("timestamp")
            df = df.where(to_timestamp_safe(col(modified_col)) > bound)
        else:
            bound = watermark if isinstance(watermark, Column) else F.lit(watermark).cast(dtype)
            df = df.where(col(modified_col) > bound)
    if deleted is not None:
        flag = col(deleted) if isinstance(deleted, str) else deleted
        if isinstance(deleted, str) and src.schema[deleted].dataType.simpleString() == "string":
            flag = F.lower(flag) == "true"
        if not include_deleted:
            df = df.where(~F.coalesce(flag, F.lit(False)))
        elif deleted_alias is not None:
            df = df.withColumn(deleted_alias,
                               F.when(F.coalesce(flag, F.lit(False)), F.lit("true")).otherwise(F.lit("false")))
    return df


def is_empty(df: DataFrame) -> bool:
    """Empty-input short cut; reads at most one row, never a full count."""
    return df.isEmpty()
