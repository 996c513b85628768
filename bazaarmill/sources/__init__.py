"""Readers, typed views and writers."""
