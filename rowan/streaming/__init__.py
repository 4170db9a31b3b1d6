"""Incremental form of batch scoring."""
