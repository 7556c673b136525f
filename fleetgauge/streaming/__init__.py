"""Structured Streaming: the batch operators over unbounded input, and stream sinks."""
