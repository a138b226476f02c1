"""The same sync driven by Structured Streaming (offsets replace the log scan)."""

from tidemark.streaming.sync_stream import start_sync_stream

__all__ = ["start_sync_stream"]
