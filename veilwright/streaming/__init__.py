"""Streams of change events."""
