"""Operators for building training-data corpora; nothing else in the package imports this."""
