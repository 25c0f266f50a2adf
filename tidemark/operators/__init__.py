"""Operators on tables."""
