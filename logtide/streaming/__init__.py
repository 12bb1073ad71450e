"""Structured Streaming: consuming, checkpoints, state."""
