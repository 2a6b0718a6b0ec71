"""Structured Streaming jobs: keyed state, sinks, start functions."""
