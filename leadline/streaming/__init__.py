"""Structured Streaming: growing logs, sampled states, tumbling buckets."""
