"""Operators for large training-data corpora (licences, contamination, tokens, toxicity, duplicates, secrets, shards).

Nothing else in the library imports this package; ``registry`` lists its queries.
"""
