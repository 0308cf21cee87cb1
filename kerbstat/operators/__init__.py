"""Reusable relational and learning steps."""
