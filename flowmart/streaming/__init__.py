"""Structured Streaming jobs: landing and continuous refresh."""
