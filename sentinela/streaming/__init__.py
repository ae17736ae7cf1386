"""Structured Streaming: event parsing, fraud rules with keyed state, alert sinks."""
