"""Operators for building training data from a text corpus; nothing else in the library imports this package."""
