"""Structured Streaming forms: stateful processors and stream runners."""
