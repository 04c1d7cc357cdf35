"""Relational operators: ``DataFrame -> DataFrame``."""
