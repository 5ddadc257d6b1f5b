"""Operators for building a language-model training corpus.

Nothing outside this subpackage imports it; ``registry`` holds the queries.
"""
