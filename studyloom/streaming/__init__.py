"""Structured Streaming over header batches."""
