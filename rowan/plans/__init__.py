"""Whole flows composed of the operators."""
