"""Structured Streaming pipelines over the batch operators."""
