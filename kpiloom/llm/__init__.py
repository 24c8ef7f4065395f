"""Operators of a training-data pipeline over documents, pages, conversations
and embeddings.  Nothing outside this package (and ``corpus_pipeline.py``)
imports it."""
