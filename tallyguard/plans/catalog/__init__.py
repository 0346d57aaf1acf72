"""Checked queries by topic; importing the modules registers them."""

from tallyguard.plans.catalog import cleaning, features, history, io, learning, parsing, profiling, streams

__all__ = ["cleaning", "features", "history", "io", "learning", "parsing", "profiling", "streams"]
