"""Operators put together: from a capture to row events."""
