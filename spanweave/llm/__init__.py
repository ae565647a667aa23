"""Operators for preparing large text corpora: scoring, deduplication, search, tokenisation."""
