"""Operators of a training-data pipeline and their registered queries.

Each module holds one operator with its own interface and, at its end, the thin
query that applies it to a whole driver table.  Nothing outside this package
imports it."""
