"""Operators for preparing language-model training data.

Each module holds one operator with its own interface; ``queries`` applies them to the
test tables. Nothing else in the library imports this package.
"""
