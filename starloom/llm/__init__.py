"""Operators for preparing training text, and their queries (see README.md in this folder)."""
