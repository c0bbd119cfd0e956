"""Corpus analytics on Spark: text quality, parsing, reconciliation, search and lifecycle operators."""
