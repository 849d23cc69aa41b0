"""Structured Streaming ingestion of delivered raw files."""

from tiermill.streaming.ingest import stream_ingest

__all__ = ["stream_ingest"]
