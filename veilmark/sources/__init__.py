"""Readers, writers and synthetic sources."""
