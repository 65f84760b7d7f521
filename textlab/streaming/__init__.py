"""Structured Streaming: stateless rule scoring of newly arriving texts."""
