"""Readers.  Each returns a DataFrame with an explicit schema."""
