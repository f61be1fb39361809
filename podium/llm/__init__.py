"""Operators of a training-data pipeline (text, pages, embeddings).

Nothing outside this package, its tests and ``corpus_pipeline.py`` imports it.
"""
