"""Operators for preparing large-scale training data.

Nothing outside this subpackage imports it. `entries.queries()` and `entries.oracle_sql()` list
its registered queries.
"""
