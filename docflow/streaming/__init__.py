"""Sinks, delivery and progress of streaming (and batch) ingest jobs."""
