"""Operators for training-data corpora, their queries and SQL oracles."""
