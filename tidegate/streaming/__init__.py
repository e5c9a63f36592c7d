"""Structured Streaming forms of extraction, dedupe, quality metrics and the sink."""
