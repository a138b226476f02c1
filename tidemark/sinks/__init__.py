"""Sinks: partitioned table writes, compaction, file-backed upsert, JDBC."""

from tidemark.sinks.table import (
    append_rows,
    compact_table,
    partition_filter,
    stage_overwrite,
    upsert_table,
    write_partitioned,
)

__all__ = ["append_rows", "compact_table", "partition_filter", "stage_overwrite",
           "upsert_table", "write_partitioned"]
