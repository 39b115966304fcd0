"""Operators of a training-data pipeline: filtering, deduplication, tokens, scoring, packing.

Nothing else in the library imports this subpackage.  Each module holds one operator with
its own general interface; ``registry`` holds the thin registered queries.
"""
