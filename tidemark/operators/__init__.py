"""DataFrame -> DataFrame operators."""

from tidemark.operators.audit import control_row, control_row_values, log_row, watermark_row
from tidemark.operators.clean import (
    add_year_month,
    bool_detect,
    boolean_flags,
    cast_all_string,
    detect_boolean_columns,
    encode_booleans,
    null_token_scrub,
    profile_extract,
    rename_for_sink,
    retype_timestamps,
)
from tidemark.operators.number import (
    batch_summary,
    row_number_global,
    row_number_ranged,
    slice_ids,
    slice_rows,
)
from tidemark.operators.qa import qa_diff, qa_union
from tidemark.operators.upsert import (
    assert_unique_keys,
    dedupe_latest,
    duplicate_keys,
    merge_counts,
    size_checked_broadcast,
    upsert_frames,
)

__all__ = [
    "add_year_month", "assert_unique_keys", "batch_summary", "bool_detect", "boolean_flags",
    "cast_all_string", "control_row", "control_row_values", "dedupe_latest",
    "detect_boolean_columns", "duplicate_keys", "encode_booleans", "log_row", "merge_counts",
    "null_token_scrub", "profile_extract", "qa_diff", "qa_union", "rename_for_sink",
    "retype_timestamps", "row_number_global", "row_number_ranged", "size_checked_broadcast",
    "slice_ids", "slice_rows", "upsert_frames", "watermark_row",
]
