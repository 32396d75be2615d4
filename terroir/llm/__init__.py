"""Operators for training-data pipelines (ten dealt methods).

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` registers the thin contract
queries over the given tables.
"""
