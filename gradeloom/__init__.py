"""Corpus curation and partial-credit scoring as Spark DataFrame operators."""
