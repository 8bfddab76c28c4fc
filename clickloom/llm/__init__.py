"""Operators for preparing training text: formats, tokens, filters, near duplicates and leaks."""
