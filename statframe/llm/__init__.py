"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``queries`` registers the thin ``opN_`` queries.
"""
