"""Structured Streaming editions of the bounded time-series operators."""
