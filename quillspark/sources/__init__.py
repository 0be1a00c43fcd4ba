"""Readers: tables, source lists, files and fetched pages."""
