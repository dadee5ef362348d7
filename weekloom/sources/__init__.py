"""Readers, column-role resolution and writers."""
