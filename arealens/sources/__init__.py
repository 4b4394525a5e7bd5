"""Readers, writers and catalog parsing."""
