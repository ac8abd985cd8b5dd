"""Operators for preparing text corpora: filtering, near-duplicate search, mixing, archives."""
