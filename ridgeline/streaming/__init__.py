"""Structured Streaming: the row-local cleaning policy as an incremental file stream."""
