"""The named queries, each a function from the accident table to a result."""
