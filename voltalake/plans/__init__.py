"""Queries and jobs composed from the operators."""
