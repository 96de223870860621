"""Operators that a training-data pipeline needs, over a table ``documents`` or ``embeddings``.

Nothing else in the package imports this subpackage.
"""
