"""Streaming use of fitted pipelines (stateless scoring)."""
