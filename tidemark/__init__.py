"""tidemark — watermarked incremental sync as Spark DataFrame operators.

Every step of an incremental load (find the last loaded point, extract the
changed and soft-deleted rows, clean them, stage them in a partitioned table,
upsert them into a main table, publish them over JDBC, append audit rows) is a
plain ``DataFrame -> DataFrame`` function that Catalyst can optimise.
"""

from tidemark.config import SyncConfig
from tidemark.session import build_session, checkpoint_root, scratch_path
from tidemark.plans.sync import LakePaths, SyncResult, load_batch, sync  # noqa: E402,I001

__all__ = ["LakePaths", "SyncConfig", "SyncResult", "build_session", "checkpoint_root",
           "load_batch", "scratch_path", "sync"]
