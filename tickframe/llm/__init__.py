"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this package; ``queries.py`` registers its
queries and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
