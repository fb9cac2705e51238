"""File-at-a-time ingestion with Structured Streaming."""
