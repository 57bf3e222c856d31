"""Structured Streaming runners, merges, windows and progress reports."""
