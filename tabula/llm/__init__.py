"""Training-data operators: packing, scoring, deduplication, archives, filters.

Nothing else in the library imports this subpackage.
"""
