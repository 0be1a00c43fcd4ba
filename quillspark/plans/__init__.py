"""Whole pipelines and the query catalogue built from operators."""
