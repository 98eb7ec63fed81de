"""Structured Streaming versions of the message operators."""
