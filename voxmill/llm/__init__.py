"""Operators for preparing text corpora: deduplication, filtering, mixing, packing, scoring."""
