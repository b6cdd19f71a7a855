"""Incremental file-to-Silver stream."""
