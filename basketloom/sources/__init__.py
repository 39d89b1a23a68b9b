"""Readers, writers and the shared stage folder."""
