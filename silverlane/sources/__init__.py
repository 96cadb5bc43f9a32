"""Readers, writers and the ingest step."""
