"""Operators for large text corpora, and their queries."""
