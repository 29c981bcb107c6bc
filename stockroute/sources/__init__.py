"""Readers and writers: CSV extracts and stored tables."""
