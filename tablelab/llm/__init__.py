"""Operators for preparing training text at scale.

Each module holds one operator with a general interface over DataFrames; the
registered queries are in ``queries``.  Nothing else in the library imports this
subpackage.
"""
