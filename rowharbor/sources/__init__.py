"""Readers, and the places results are written to."""
