"""Structured Streaming forms of merge, stitch and resample."""
