"""Operators for training-data pipelines over documents and web pages; their queries are in :mod:`saltmarsh.llm.queries`."""
