"""Operators for preparing training text: decontamination, sharding, near duplicates, secrets, tokens, quality, PII."""
