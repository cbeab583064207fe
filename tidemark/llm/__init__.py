"""Operators for preparing text and embedding corpora at scale.

Nothing else in the library imports this subpackage.
"""
