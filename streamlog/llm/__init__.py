"""Operators for large text corpora; each module states its method and edge cases."""
