"""Readers, the shared staging folder, and writers."""
