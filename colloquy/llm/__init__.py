"""Operators over text, page and vector tables that a training-data pipeline needs.

Nothing else in the library imports this subpackage.
"""
