"""Readers, writers and the loan view over the supplied tables."""
