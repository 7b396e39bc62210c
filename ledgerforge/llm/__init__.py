"""Operators for training-data corpora, each a function on DataFrames.

Nothing outside this subpackage imports it; it may be deleted together with ``tests/llm``
and ``corpus_pipeline.py``.
"""
