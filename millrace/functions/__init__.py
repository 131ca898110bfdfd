"""Columns and small helpers: predicates over jobs and workers, scalar functions, ids."""
