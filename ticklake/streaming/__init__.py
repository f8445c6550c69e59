"""Structured Streaming: sources/sinks, checkpointed landing, feed publishing, streaming marts."""
