"""Operators for large training corpora: search, mixing, extraction,
language ID, filters, tokenization, archives, fingerprints and dedup.

Nothing else in the library imports this subpackage.
"""
