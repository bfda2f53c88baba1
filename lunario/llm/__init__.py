"""Operators for preparing text corpora: tokenising, deduplicating, scoring, mixing, archiving."""
