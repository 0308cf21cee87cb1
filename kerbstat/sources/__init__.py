"""Readers and writers of the accident table."""
