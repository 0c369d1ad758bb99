"""Operators for building training data: deduplication, filtering, tokenising, packing.

Nothing else in the library imports this subpackage.
"""
