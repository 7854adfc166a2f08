"""Answers read as they arrive."""
