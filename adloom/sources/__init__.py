"""Readers, writers and the stream catalogue."""
