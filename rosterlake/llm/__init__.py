"""Operators for preparing language-model training text.

Nothing outside this package imports it. Each module holds one operator with
its own general interface; ``queries`` binds them to the given tables.
"""
