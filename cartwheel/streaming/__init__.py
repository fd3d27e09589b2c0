"""Structured Streaming jobs: request scoring (N2) and the error alarm."""
