"""Structured Streaming scoring, quarantine and prediction log."""
