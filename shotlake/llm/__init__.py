"""Operators on text and vectors for preparing training data.

Nothing outside this subpackage imports it.
"""
