"""Readers, fixed dimensions, schemas and table writers."""
