"""Structured Streaming entry points over the batch operators."""
