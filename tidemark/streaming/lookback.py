"""The look-back of the watermark under Structured Streaming.

A pull asks the source for rows changed after the last watermark minus a
look-back, so that rows which became visible late are still fetched.  The same
look-back delivers rows of the pull before once more.  As a stream, pulls are
micro-batches; a state store remembers the keys of the look-back and lets each
version of a key pass once.  State is bounded: a key is forgotten once the
watermark has passed its time by the look-back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_redelivered(stream: DataFrame, keys: list[str], time_col: str, lookback_seconds: int = 600) -> DataFrame:
    """Rows of ``stream`` without those that the look-back delivered again.

    ``keys`` name a version of a row (record key and modification time, say).
    ``time_col`` must be a TIMESTAMP.  A row older than the greatest time of
    the earlier micro-batches by more than the look-back is late and dropped,
    as a pull could not have fetched it either.
    """
    return stream.withWatermark(time_col, f"{int(lookback_seconds)} seconds").dropDuplicatesWithinWatermark(keys)
