"""Operators for preparing language-model training data (see ``queries`` for the registered ones).

Nothing else in the library imports this subpackage.
"""
