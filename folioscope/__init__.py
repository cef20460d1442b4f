"""Corpus analytics on Spark: load, clean, vectorise, match, evaluate and cluster documents."""
