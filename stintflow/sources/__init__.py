"""Readers, writers and publishing jobs."""
