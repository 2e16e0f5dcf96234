"""Operators put together: inputs derived from the tables, queries, the batch run."""
