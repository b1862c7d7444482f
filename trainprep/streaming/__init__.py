"""Structured Streaming: incremental folder ingestion."""
