"""Structured Streaming entry points for the stateless part of harmonisation."""
