"""Operators of a training-data pipeline: filtering, deduplication, tokens, packing, scoring.

Nothing else in the library imports this subpackage. ``queries`` applies every
operator to its whole table; ``corpus_pipeline.py`` at the top of the repository
chains five of them.
"""
