"""Structured Streaming forms of the gate, deduplication, watermarks and state machines."""
