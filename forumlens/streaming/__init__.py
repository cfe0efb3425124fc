"""Structured Streaming forms of the sliding window, first-seen filter and snapshot delta."""
