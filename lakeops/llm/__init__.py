"""Operators of a training-data pipeline (ranking, filtering, deduplication,
mixing, extraction, packing) and their registered queries.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is present.
"""
