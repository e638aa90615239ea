"""Operators for building training corpora: filtering, deduplication, splitting, tokens and scores.

Nothing else in the package imports this subpackage.  ``queries`` registers one query per operator.
"""
