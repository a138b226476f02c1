"""Cleaning and encoding: scrub, boolean detection/encoding, partition key,
uniform typing, renames for a sink with an identifier limit.

Every operator is one ``select`` over all columns (no per-column
``withColumn`` loop, no per-column job).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.columns import bool_encode, col, scrub, to_timestamp_safe, year_month

TRUE_TEXT = "true"
FALSE_TEXT = "false"


def null_token_scrub(df: DataFrame, token: str = "null", whole_value: bool = False,
                     columns: list[str] | None = None) -> DataFrame:
    """Remove the ``token`` text from every (chosen) column; all become text."""
    chosen = set(df.columns if columns is None else columns)
    return df.select([scrub(col(c), token, whole_value).alias(c) if c in chosen else col(c)
                      for c in df.columns])


def _is_boolean_text(s: Column) -> Column:
    """Aggregate: some value is true/false and every non-NULL value is true/false/''."""
    has_tf = F.count_if(s.isin(TRUE_TEXT, FALSE_TEXT)) > 0
    all_ok = F.coalesce(F.bool_and(s.isin(TRUE_TEXT, FALSE_TEXT, "")), F.lit(True))
    return has_tf & all_ok


def _text_columns(df: DataFrame, columns: list[str] | None) -> list[str]:
    return [c for c in (df.columns if columns is None else columns)
            if isinstance(df.schema[c].dataType, StringType)]


def boolean_flags(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One-row frame, one boolean per column: does it hold boolean text?

    A column is boolean when at least one value is ``true``/``false`` and
    every non-NULL value is ``true``, ``false`` or ``""``.  One aggregate over
    all columns (partial aggregation per task, one tiny final row).
    """
    cols = _text_columns(df, columns)
    if not cols:
        return df.sparkSession.range(1).select()
    return df.agg(*[_is_boolean_text(col(c)).alias(c) for c in cols])


def bool_detect(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Detection result as rows ``(column_name, is_boolean)``."""
    flags = boolean_flags(df, columns)
    if not flags.columns:
        return df.sparkSession.createDataFrame([], "column_name string, is_boolean boolean")
    pairs = [F.struct(F.lit(c).alias("column_name"), col(c).alias("is_boolean")) for c in flags.columns]
    return flags.select(F.inline(F.array(*pairs)))


def detect_boolean_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Names of the boolean columns; one row of flags reaches the driver."""
    flags = boolean_flags(df, columns)
    if not flags.columns:
        return []
    row = flags.first()
    return [c for c in flags.columns if row[c]]


def encode_booleans(df: DataFrame, columns: list[str] | None = None, null_as: int | None = 1) -> DataFrame:
    """Encode boolean text as 0/1 ints; detects the columns when not given."""
    chosen = set(detect_boolean_columns(df) if columns is None else columns)
    if not chosen:
        return df
    return df.select([bool_encode(col(c), null_as).alias(c) if c in chosen else col(c)
                      for c in df.columns])


def add_year_month(df: DataFrame, source_col: str, out_col: str) -> DataFrame:
    """Append the ``yyyyMM`` partition key derived from ``source_col``."""
    return df.withColumn(out_col, year_month(col(source_col), df.schema[source_col].dataType))


def cast_all_string(df: DataFrame) -> DataFrame:
    """Every column to text, names and order kept."""
    return df.select([col(c).cast("string").alias(c) for c in df.columns])


def retype_timestamps(df: DataFrame, columns: list[str] | tuple[str, ...], ntz: bool = False) -> DataFrame:
    """Text columns back to timestamps; empty or bad text gives NULL."""
    chosen = set(columns)
    return df.select([to_timestamp_safe(col(c), ntz).alias(c) if c in chosen else col(c)
                      for c in df.columns])


def check_identifiers(names: list[str], limit: int = 30) -> None:
    """Raise if a name is longer than ``limit`` or two names collide (case-insensitive)."""
    too_long = [n for n in names if len(n) > limit]
    if too_long:
        raise ValueError(f"identifiers longer than {limit}: {too_long}")
    seen: dict[str, str] = {}
    for n in names:
        k = n.lower()
        if k in seen:
            raise ValueError(f"identifier collision: {seen[k]!r} and {n!r}")
        seen[k] = n


def rename_for_sink(df: DataFrame, mapping: dict[str, str], limit: int | None = 30) -> DataFrame:
    """Rename columns for a sink, checking length limit and collisions."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise ValueError(f"columns to rename not found: {missing}")
    out = [mapping.get(c, c) for c in df.columns]
    if limit is not None:
        check_identifiers(out, limit)
    return df.select([col(c).alias(mapping.get(c, c)) for c in df.columns])


def profile_extract(df: DataFrame, modified_col: str | None = None,
                    partition_col: str | None = None,
                    bool_candidates: list[str] | None = None) -> dict:
    """One global aggregate with what a load needs to know up front.

    Returns ``rows``, ``max_modified`` (text, cast before the max),
    ``partitions`` (set of partition values, one entry per partition) and
    ``booleans`` (detected among ``bool_candidates``).  Every task sends one
    partial row; nothing is grouped by key.
    """
    cands = _text_columns(df, bool_candidates or [])
    aggs = [F.count(F.lit(1)).alias("__rows")] + [_is_boolean_text(col(c)).alias(f"__b_{i}")
                                                  for i, c in enumerate(cands)]
    if modified_col is not None:
        m = col(modified_col)
        m = to_timestamp_safe(m) if isinstance(df.schema[modified_col].dataType, StringType) else m
        aggs.append(F.date_format(F.max(m), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("__max"))
    if partition_col is not None:
        aggs.append(F.collect_set(col(partition_col)).alias("__parts"))
        aggs.append(F.bool_or(col(partition_col).isNull()).alias("__null_part"))
    row = df.agg(*aggs).first()
    parts = None
    if partition_col is not None:
        parts = list(row["__parts"]) + ([None] if row["__null_part"] else [])
    return {"rows": row["__rows"],
            "max_modified": row["__max"] if modified_col is not None else None,
            "partitions": parts,
            "booleans": [c for i, c in enumerate(cands) if row[f"__b_{i}"]]}
