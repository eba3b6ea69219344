"""Operators for training data, with their queries and SQL."""
