"""Operators that prepare text, vectors and pages for model training.

Nothing outside this subpackage imports it.
"""
