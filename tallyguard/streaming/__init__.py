"""Structured Streaming: ingest, dedupe, summaries, scoring, customer profile."""
