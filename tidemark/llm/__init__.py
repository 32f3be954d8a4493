"""Operators for preparing training corpora, each with a registered query.

Nothing outside this subpackage imports it. ``queries.QUERIES`` and ``queries.ORACLE_SQL`` are what the
driver's entry module adds.
"""
