"""Sources: table scans, watermark lookup, incremental extract, JDBC scan."""

from tidemark.sources.extract import incremental_extract, is_empty
from tidemark.sources.jdbc import jdbc_subquery_scan
from tidemark.sources.tables import read_partitioned, read_table, scan_all, table_exists
from tidemark.sources.watermark import (
    read_watermark,
    watermark_literal,
    watermark_lookup,
)

__all__ = ["incremental_extract", "is_empty", "jdbc_subquery_scan", "read_partitioned", "read_table",
           "scan_all", "table_exists", "read_watermark", "watermark_literal",
           "watermark_lookup"]
