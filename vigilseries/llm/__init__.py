"""Operators for training data: tokens, duplicates, contamination, quality, language and formatting."""
