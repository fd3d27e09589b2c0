"""Operators of a training-data pipeline over the tables documents and pages.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
