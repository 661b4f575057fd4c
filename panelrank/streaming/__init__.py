"""Structured Streaming micro-batch rollup."""
