"""Readers, writers and the adapter views on the generic test tables."""
