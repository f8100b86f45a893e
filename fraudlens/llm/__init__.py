"""Operators for large text corpora: filters, near-duplicate detection, decontamination, token work."""
