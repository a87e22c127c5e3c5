"""Operators for training-data pipelines over ``documents`` and ``pages``.

Nothing outside this package imports it. Operators take DataFrames and column
names; the thin queries of ``queries.py`` derive the registered digests.
"""
