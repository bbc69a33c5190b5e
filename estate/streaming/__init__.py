"""Structured Streaming form of the incremental extract."""
