"""Streaming: the reference has no streaming operator (every script is a full
rebuild).  The one piece offered here is the staging load itself as a
file-source stream, so files that arrive over time are appended exactly once
(see ``ingest``)."""

from spendstar.streaming.ingest import ingest_spend, stream_spend

__all__ = ["ingest_spend", "stream_spend"]
