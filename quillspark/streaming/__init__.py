"""Structured Streaming counterparts of the batch stages."""
