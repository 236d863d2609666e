"""Operators for preparing training text: extraction, filtering, deduplication, mixing, tokens and shards.

Nothing else in the library imports this subpackage.
"""
