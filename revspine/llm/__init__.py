"""Operators for preparing language-model training data.

Each module holds one operator with its general interface; ``queries`` holds
the registered queries and ``oracle`` their SQL.  Nothing outside this package
imports it.
"""
