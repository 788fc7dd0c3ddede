"""Incremental ingest."""

from eventloom.streaming.ingest import DailyIngest

__all__ = ["DailyIngest"]
