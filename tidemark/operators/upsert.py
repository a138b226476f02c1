"""Upsert (MERGE) as DataFrame operators.

``result = source  UNION ALL  (target ANTI JOIN source ON keys)``

* The source (the incremental change set) decides: a NULL in the source
  overwrites the target value (no ``coalesce``).
* Keys compare null-safe (``<=>``): a NULL key part matches a NULL key part,
  so such rows are not inserted again on every run.
* Only the source's key columns take part in the join.  They are broadcast
  when their size is known to be below a bound, and joined by a shuffled merge
  join when it is known to be above; with unknown rows Spark chooses (and AQE
  may still switch at run time).  The target is never shuffled when the source
  keys are broadcast.
* Duplicate source keys are an error, or are resolved by ``dedupe_latest``,
  which keeps the latest row per key with a partial (map-side) group limit,
  so a hot key never lands whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from tidemark.functions.columns import col, to_timestamp_safe

# Upper bound for a broadcast build side, in estimated bytes of the key rows.  The
# driver and every executor hold it, and a run plans several, so it stays small.
DEFAULT_BROADCAST_LIMIT = 32 * 1024 * 1024


# Bytes of a fixed-width value; the width of text and binary keys is measured.
_FIXED_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4,
                "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
# A hashed row on top of its values: hash table slots, row headers, and the copy of
# the key with its null flags (measured: 145 bytes a row of a long and a 6-byte text).
ROW_OVERHEAD = 128


def _variable(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.dataType.typeName() not in _FIXED_BYTES]


def key_bytes(df: DataFrame, rows: int | None) -> int | None:
    """Bytes of the rows of ``df`` in a broadcast relation; None when ``rows`` is.

    Fixed-width columns are counted from ``rows``; one aggregate adds up the
    true width of the others.
    """
    if rows is None:
        return None
    fixed = sum(_FIXED_BYTES.get(f.dataType.typeName(), 0) for f in df.schema.fields) + ROW_OVERHEAD
    wide = _variable(df.schema)
    if not wide:
        return rows * fixed
    width = reduce(lambda a, b: a + b, [
        F.coalesce(F.octet_length(col(c) if isinstance(df.schema[c].dataType, (StringType, BinaryType))
                                  else col(c).cast("string")), F.lit(0)).cast("long") for c in wide])
    return rows * (fixed + 8 * len(wide)) + (df.agg(F.sum(width)).first()[0] or 0)


def fits_broadcast(df: DataFrame, rows: int | None, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> bool:
    """True when ``rows`` is known and the rows' measured size is within the bound."""
    if rows is None or rows * ROW_OVERHEAD > limit_bytes:
        return False  # too many whatever their width: no need to measure it
    return key_bytes(df, rows) <= limit_bytes


def size_checked_broadcast(df: DataFrame, rows: int | None,
                           limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when ``rows`` is known and the measured size fits.

    Known rows that do not fit are joined by shuffle: the planner guesses a
    table's size from its compressed files and would broadcast some of them.
    """
    if rows is None:
        return df
    return F.broadcast(df) if fits_broadcast(df, rows, limit_bytes) else df.hint("merge")


def _renamed_keys(source: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    names = [f"__src_key_{i}" for i in range(len(keys))]
    return source.select([col(k).alias(n) for k, n in zip(keys, names)]), names


def _null_safe(keys: list[str], other: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [col(k).eqNullSafe(col(o)) for k, o in zip(keys, other)])


def check_same_columns(target: DataFrame, source: DataFrame) -> None:
    t = {c.lower() for c in target.columns}
    s = {c.lower() for c in source.columns}
    if t != s:
        raise ValueError(f"column sets differ: only target {sorted(t - s)}, only source {sorted(s - t)}")


def with_missing_columns(target: DataFrame, source: DataFrame, keys: list[str], *,
                         source_rows: int | None = None,
                         broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """``source`` with the target's columns that it lacks.

    A source of fewer columns updates only those: matched rows take the others
    from the target, new rows have NULL there.
    """
    have = {c.lower() for c in source.columns}
    missing = [c for c in target.columns if c.lower() not in have]
    if not missing:
        return source
    old = _narrowed(target.select([col(k) for k in keys] + [col(c) for c in missing]), source, keys,
                    source_rows, broadcast_limit)
    names = [f"__old_key_{i}" for i in range(len(keys))]
    old = old.select([col(k).alias(n) for k, n in zip(keys, names)] + [col(c) for c in missing])
    return source.join(old, on=_null_safe(keys, names), how="left").select(
        [col(c) for c in source.columns] + [col(c) for c in missing])


def without_older(target: DataFrame, source: DataFrame, keys: list[str], time_col: str, *,
                  source_rows: int | None = None,
                  broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Source rows that are not older than the target's row of the same key."""
    def time_of(df: DataFrame) -> Column:
        c = col(time_col)
        return to_timestamp_safe(c) if isinstance(df.schema[time_col].dataType, StringType) else c

    names = [f"__old_key_{i}" for i in range(len(keys))]
    old = _narrowed(target.select([col(k) for k in dict.fromkeys([*keys, time_col])]), source, keys,
                    source_rows, broadcast_limit)
    old = old.select([col(k).alias(n) for k, n in zip(keys, names)] + [time_of(old).alias("__old_time")])
    older = _null_safe(keys, names) & (F.col("__old_time") > time_of(source))
    return source.join(old, on=older, how="left_anti")


def upsert_frames(target: DataFrame, source: DataFrame, keys: list[str], *,
                  source_rows: int | None = None,
                  broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                  source_layout=None, source_keys: DataFrame | None = None) -> DataFrame:
    """Merged frame: every source row, plus target rows whose key is not in source.

    Output columns follow the target's order.  ``source_layout`` (a function
    of a frame) re-arranges only the source rows of the union, e.g. to
    cluster them for a partitioned write while the target rows keep the
    layout of their scan.  ``source_keys`` is a frame with the same keys that
    is cheaper to compute than ``source``.
    """
    check_same_columns(target, source)
    src_keys, names = _renamed_keys(source if source_keys is None else source_keys, keys)
    src_keys = size_checked_broadcast(src_keys, source_rows, broadcast_limit)
    kept = target.join(src_keys, on=_null_safe(keys, names), how="left_anti")
    order = [col(c) for c in target.columns]
    rows = source if source_layout is None else source_layout(source)
    return rows.select(order).unionByName(kept.select(order))


def matched_target_rows(target: DataFrame, source: DataFrame, keys: list[str], *,
                        source_rows: int | None = None,
                        broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Target rows whose key occurs in the source (left semi join)."""
    src_keys, names = _renamed_keys(source, keys)
    src_keys = size_checked_broadcast(src_keys, source_rows, broadcast_limit)
    return target.join(src_keys, on=_null_safe(keys, names), how="left_semi")


def _narrowed(target: DataFrame, source: DataFrame, keys: list[str], source_rows: int | None,
              broadcast_limit: int) -> DataFrame:
    """``target`` before a join with ``source`` on ``keys``: only its matched rows, where that saves a shuffle.

    Known source keys that are too many to broadcast would shuffle the target
    once for the semi join and again for the join that follows.
    """
    if source_rows is not None and not fits_broadcast(_renamed_keys(source, keys)[0], source_rows, broadcast_limit):
        return target.hint("merge")  # as the source, it is too large to broadcast by a guess
    return matched_target_rows(target, source, keys, source_rows=source_rows, broadcast_limit=broadcast_limit)


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (partial count per task, then merge)."""
    return (source.groupBy([col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
                  .where(F.col("n_rows") > 1))


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """Raise when the source holds a key twice; the MERGE outcome would be undefined."""
    if not duplicate_keys(source, keys).isEmpty():
        sample = [tuple(r[:len(keys)]) for r in duplicate_keys(source, keys).take(5)]
        raise ValueError(f"source has duplicate keys on {keys}, e.g. {sample}")


def dedupe_latest(source: DataFrame, keys: list[str], order_cols: str | list[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``order_cols`` (e.g. the modification time).

    Remaining ties are broken by a hash of the whole row, so the choice is
    deterministic.  ``row_number() = 1`` per key is planned with a partial
    group limit before the shuffle: each task sends at most one row per key,
    however hot the key is.
    """
    cols = source.columns
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    # Text that holds times is ordered as instants first, then as text.
    rank = []
    for c in order:
        if isinstance(source.schema[c].dataType, StringType):
            rank.append(to_timestamp_safe(col(c)).desc_nulls_last())
        rank.append(col(c).desc_nulls_last())
    rank = rank + [F.xxhash64(*[col(c) for c in cols]).desc()]
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*rank)
    return (source.withColumn("__rn", F.row_number().over(w))
                  .where(F.col("__rn") == 1).drop("__rn"))


def merge_counts(target: DataFrame, source: DataFrame, keys: list[str], *,
                 source_rows: int | None = None) -> dict[str, int]:
    """``updated`` / ``inserted`` counts of an upsert (keys unique on both sides)."""
    n_src = source.count() if source_rows is None else source_rows
    key_only = target.select([col(k) for k in keys])
    updated = matched_target_rows(key_only, source, keys, source_rows=n_src).count()
    return {"source_rows": n_src, "updated": updated, "inserted": n_src - updated}
