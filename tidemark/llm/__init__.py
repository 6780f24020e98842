"""Operators for preparing training text and vectors; nothing else in the library imports this subpackage.

``queries.QUERIES`` registers one query per operator; ``/corpus_pipeline.py`` chains five of them.
"""
