"""Incremental drivers: the batch operators applied to newly arrived files."""
