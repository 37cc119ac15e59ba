"""Operators of a training-data pipeline over documents, embeddings and pages.

Nothing outside this package imports it; ``__spark_entry__.py`` registers its
queries (``queries.py``) when the package is present."""
