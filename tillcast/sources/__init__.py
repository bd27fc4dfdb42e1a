"""Readers, writers and table locations."""
