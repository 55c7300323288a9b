"""Structured Streaming: incremental bronze ingest and incremental silver."""
