"""Arrival-driven variants of the batch flows (Structured Streaming)."""
