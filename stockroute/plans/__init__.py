"""Compositions of the operators: the lazy flow, the staged pipeline, the
registered queries and their oracle SQL."""
