"""Operators for preparing training text: tokens, packing, quality, fingerprints, secrets, near duplicates."""
