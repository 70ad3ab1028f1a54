"""Structured Streaming helpers and the incremental loader."""
