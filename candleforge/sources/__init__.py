"""Landed files, the file manifest and partitioned tables."""
