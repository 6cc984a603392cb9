"""The operators on unbounded input, with Structured Streaming."""
