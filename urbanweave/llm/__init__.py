"""Operators of a training-data pipeline: sharding, quality, decontamination, search, deduplication, packing, scoring, archives.

Nothing else in the library imports this package. Its queries are in :mod:`urbanweave.llm.queries`.
"""
