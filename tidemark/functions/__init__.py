"""Column expressions (all built-in, JVM-side, inside whole-stage codegen)."""

from tidemark.functions.columns import (
    bool_encode,
    col,
    scrub,
    to_timestamp_safe,
    utc_to_zone,
    watermark_text,
    year_month,
)

__all__ = ["bool_encode", "col", "scrub", "to_timestamp_safe", "utc_to_zone",
           "watermark_text", "year_month"]
