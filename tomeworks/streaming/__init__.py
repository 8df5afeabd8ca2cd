"""Structured Streaming forms of the batch jobs."""

from .ingest import append_stream, ingest_stream
from .snapshots import append_deltas, current_snapshot, mark_removed, rebaseline, snapshot_stream, versions

__all__ = [
    "append_deltas", "append_stream", "current_snapshot", "ingest_stream", "mark_removed", "rebaseline", "snapshot_stream",
    "versions",
]
