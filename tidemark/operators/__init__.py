"""Composed DataFrame operators."""
