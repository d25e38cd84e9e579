"""Operators for building training corpora, and their registered queries.

Nothing outside this package imports it. ``queries.QUERIES`` and ``queries.ORACLES`` hold what
``__spark_entry__`` registers; each operator lives in a module of its own.
"""
