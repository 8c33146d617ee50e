"""Structured Streaming: incremental file ingestion and change history."""
