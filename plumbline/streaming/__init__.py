"""Structured Streaming forms of the checks, counters and scoring."""
