"""Operators for training-data pipelines, their queries and SQL counterparts.

Nothing else in the library imports this subpackage.
"""
