"""Structured Streaming: scoring of new orders and running seller totals."""
