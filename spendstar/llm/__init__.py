"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing else in the library imports this subpackage.  One module per
operator; ``queries.py`` holds the registered ``opN_`` queries and their SQL.
"""
