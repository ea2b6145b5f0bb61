"""Incremental, resumable runs with Structured Streaming (L1)."""
