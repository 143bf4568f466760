"""Operators of a training-data pipeline: tokenizing, extraction, filtering,
deduplication, decontamination, nearest neighbours and archives.

Nothing outside this package imports it; `__spark_entry__` registers its
queries when it is present.
"""
