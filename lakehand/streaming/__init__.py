"""Optional Structured Streaming delivery of the incremental loads."""
