"""Operators for training data: search, deduplication, filters, tokenizers, packing, extraction, quality.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator.
"""
