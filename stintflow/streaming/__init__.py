"""Structured Streaming over event feeds."""
