"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this package.  ``queries`` holds the
registered queries and their SQL.
"""
