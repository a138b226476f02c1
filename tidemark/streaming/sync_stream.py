"""Incremental sync as a Structured Streaming query.

A streaming source (files landing in a folder, a message bus, ...) already
tracks what was read in its checkpoint, so no watermark lookup is needed to
find new rows: each micro-batch goes through :func:`load_batch` (clean,
stage, upsert, logs) under ``foreachBatch``.  The batch's number goes into the
control log, so a batch replayed after a failure is skipped if it was logged;
one that failed earlier is repeated, which the idempotent upsert allows.  The look-back of the
batch form is not needed: the source offsets are exact.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import SyncConfig
from tidemark.plans.sync import LakePaths, load_batch


def start_sync_stream(stream: DataFrame, cfg: SyncConfig, lake: LakePaths,
                      checkpoint_location: str,
                      available_now: bool = True,
                      processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what is there and stops.

    The config must name ``bool_columns`` (what one micro-batch holds says
    nothing about the next) and ``dedupe_by`` (a change stream brings several
    versions of a key in one batch).  Versions may also arrive out of order, so
    a row older than main's row always loses here.
    """
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required: without it a restart forgets what was read")
    if cfg.bool_columns is None or cfg.dedupe_by is None:
        raise ValueError("a streaming sync needs bool_columns and dedupe_by in its config")
    cfg = replace(cfg, newest_wins=True)

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        # The query's id lives in its checkpoint, so a new checkpoint starts a new series.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint_location
        load_batch(batch.sparkSession, batch, cfg, lake, batch_id=f"{query}:{epoch_id}")

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_location)
    if processing_time is not None:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
