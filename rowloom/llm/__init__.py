"""Operators for preparing large training corpora.

Each module holds one operator with its parameters, `queries.py` binds them to the tables, and nothing
outside this subpackage imports it.
"""
