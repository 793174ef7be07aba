"""Readers of the input and stored tables."""
