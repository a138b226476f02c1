"""One parameter object for a sync; no column list is hard-coded anywhere."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SyncConfig:
    table_name: str                       # name written to the logs
    key_cols: tuple[str, ...]             # record key
    modified_col: str                     # modification time = watermark column
    partition_col: str                    # partition key of stage and main table
    created_col: str | None = None        # source of the partition key
    deleted_col: str | None = None        # soft-delete flag column (text true/false)
    include_deleted: bool = True          # keep soft-deleted rows in the extract
    merge_on_partition: bool = True       # True: key + partition (composite); False: key only
    lookback_seconds: int = 600
    columns: tuple[str, ...] | None = None    # projection of the extract; None = all
    bool_columns: tuple[str, ...] | None = None  # explicit booleans win over detection
    detect_booleans: bool = True
    null_bool_as: int = 1                 # encoding of NULL booleans (parity: 1)
    scrub_token: str | None = "null"      # None disables the scrub
    scrub_whole_value: bool = False
    dedupe_by: str | None = None          # resolve duplicate source keys by latest value
    newest_wins: bool = False             # a source row older than main's row loses
    timestamp_cols: tuple[str, ...] = ()  # publish: re-typed to timestamp
    rename_map: dict = field(default_factory=dict)   # publish: names in the database
    identifier_limit: int = 30            # publish: longest name there
    slice_size: int = 10000               # publish: rows per bounded transaction
    zone: str = "UTC"                     # zone of the run time in the logs

    @property
    def merge_keys(self) -> list[str]:
        keys = list(self.key_cols)
        if self.merge_on_partition and self.partition_col not in keys:
            keys.append(self.partition_col)
        return keys
