"""Operators for preparing training data: packing, WARC archives, near-duplicate and substring
removal, toxicity scores, sharding, token encoding and document fingerprints.

Each module holds one operator; ``queries`` registers them.  Nothing else in the library imports
this package.
"""
