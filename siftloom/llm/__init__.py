"""Operators for language-model training data. Nothing outside this package imports it."""

CATALOGUE = ["text_queries", "duplicate_queries", "corpus_queries", "answer_queries"]
