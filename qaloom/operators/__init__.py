"""Relational operators."""
