"""Structured Streaming entry points (incremental DW maintenance over the lake)."""
