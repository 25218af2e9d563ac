"""Structured Streaming jobs: message parsing, scoring, keyed upserts, windowed averages."""
