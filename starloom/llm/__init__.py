"""Operators for preparing text for the training of language models.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
