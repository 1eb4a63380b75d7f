"""Structured Streaming: the ``appendlog`` source, offset backup, job helpers."""
