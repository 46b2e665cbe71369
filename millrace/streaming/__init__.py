"""Endless jobs on Structured Streaming."""
