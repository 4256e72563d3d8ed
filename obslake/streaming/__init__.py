"""Structured Streaming wiring of the operators."""
