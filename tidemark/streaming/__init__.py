"""Incremental forms of landing and of newest-row tables."""
