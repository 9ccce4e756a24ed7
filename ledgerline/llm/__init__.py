"""Operators of a training-data pipeline over the ``documents`` and ``pages`` tables.

Nothing else in the package imports this subpackage. Each module holds one operator with its
general interface; ``queries.py`` registers the thin queries and their SQL.
"""
