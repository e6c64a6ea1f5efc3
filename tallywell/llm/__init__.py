"""Operators for the preparation of training data for language models; nothing else in the library imports this package."""
