"""Operators for large text corpora: scoring, deduplication, decontamination, archives, tokens, privacy."""
