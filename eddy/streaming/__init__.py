"""Structured Streaming forms: replay runner, sinks, stateful processors."""
