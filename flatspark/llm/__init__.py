"""Operators of a training-data pipeline over document, page, vector and conversation tables.

Nothing else in the library imports this subpackage.
"""
