"""Operators for large training-data corpora, each a Spark job over whole tables."""
