"""Training-data operators: deduplication, scoring, mixing, packing.

Nothing else in the library imports this subpackage.
"""
