"""Operators of a training-data pipeline: ten set-based Spark jobs and their queries.

Nothing else in the library imports this subpackage.
"""
