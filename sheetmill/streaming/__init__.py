"""Incremental landing of newly arrived source files (Structured Streaming)."""
