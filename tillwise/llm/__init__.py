"""Training-data operators: scoring, filtering, deduplication, extraction and encoding of texts.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds its queries
when the package is present.
"""
