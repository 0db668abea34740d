"""Operators for preparing training data: one module for each, see ``entry`` for the registered queries.

Nothing outside this package imports it, and it imports nothing from the rest of the library.
"""
