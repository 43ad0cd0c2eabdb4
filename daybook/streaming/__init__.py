"""Streaming form of the bronze ingest."""

from daybook.streaming.ingest import bronze_stream, start_bronze_ingest

__all__ = ["bronze_stream", "start_bronze_ingest"]
