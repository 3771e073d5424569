"""Structured Streaming form of the incremental audit."""
