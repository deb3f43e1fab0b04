"""Structured Streaming: incremental exactly-once ingest and late-data operators."""
