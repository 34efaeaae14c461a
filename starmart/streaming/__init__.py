"""Inbox ingestion with Structured Streaming."""
