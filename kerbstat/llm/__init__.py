"""Operators for preparing text and vector collections; nothing else in the package imports this."""
