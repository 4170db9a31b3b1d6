"""Readers, writers and the run store."""
