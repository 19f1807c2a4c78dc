"""Structured Streaming jobs over vehicle positions."""
