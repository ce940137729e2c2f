"""Operators that prepare text corpora for language-model training.

Nothing else in the library imports this package. Each module holds one operator with a general
interface; ``queries`` holds the thin, fixed-contract queries over the standard tables.
"""
