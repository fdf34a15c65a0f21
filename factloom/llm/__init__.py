"""Training-data operators: deduplication, classifiers, search, tokens and packing.

Nothing else in the library imports this subpackage; it can be deleted as a whole.
"""
