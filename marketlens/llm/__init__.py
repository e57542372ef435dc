"""Operators for building text and embedding corpora for training. Nothing else in the library imports this package."""
