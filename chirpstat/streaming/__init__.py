"""Structured Streaming forms of the analyses."""
