"""Operators for building training corpora: filters, dedup, scoring, tokenisation, privacy."""
