"""The batch operators run incrementally with Structured Streaming."""
