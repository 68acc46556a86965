"""Structured Streaming twins of the run modes (ST1, ST2)."""
