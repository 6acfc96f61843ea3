"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the package imports this subpackage; ``registry`` lists its
queries and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
