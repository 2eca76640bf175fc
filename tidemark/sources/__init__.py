"""Readers, row identity and writers."""
