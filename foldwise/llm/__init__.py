"""Operators of a training-data pipeline: ten corpus operators, their queries and SQL."""
