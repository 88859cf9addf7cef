"""Structured Streaming jobs and stateful operators."""
