"""Operators of a training-data pipeline: dedup, filters, tokens, packing, scoring.

Each module is one operator with a general interface; ``queries`` registers the
thin queries over the given tables.
"""
