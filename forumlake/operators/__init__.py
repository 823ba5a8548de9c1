"""Relational building blocks the plans are composed of."""
