"""Capture schemas and readers."""
