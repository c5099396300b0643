"""Operators for preparing training data at scale: search, quality, archives, extraction, de-duplication, tokens."""
