"""Operators of a training-data pipeline over the corpus tables.

Nothing outside this package imports it; ``queries`` registers one query per
operator and ``corpus_pipeline.py`` at the repository top chains them.
"""
