"""Operators for training data: deduplication, mixing, scoring, archives, secrets."""
