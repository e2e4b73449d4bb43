"""Readers. Each takes the session and a path (or options) and returns a DataFrame."""
