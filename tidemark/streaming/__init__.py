"""Structured Streaming loads."""

from tidemark.streaming.events import first_arrivals, ingest_events
from tidemark.streaming.ingest import ingest

__all__ = ["first_arrivals", "ingest", "ingest_events"]
