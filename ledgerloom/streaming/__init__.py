"""Structured Streaming ingestion of the landing directory."""
