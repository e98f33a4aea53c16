"""Structured Streaming entry points."""

from casegrid.streaming.ingest import case_file_stream, start_historical_ingest

__all__ = ["case_file_stream", "start_historical_ingest"]
