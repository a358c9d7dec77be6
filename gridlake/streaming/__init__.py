"""Structured Streaming: live price decoding and scoring."""
