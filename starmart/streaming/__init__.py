"""The batch jobs fed by Structured Streaming."""
